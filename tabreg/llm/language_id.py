"""Language identification by fusing evidence.

Text likelihoods come from a character model per language. They are combined
by Bayes' rule with the declared markup language, the address suffix and a
prior for the host. Suffix likelihoods and host priors come from grouped sums
of the text's probabilities over all rows; a host's prior is smoothed towards
its domain's, that towards its suffix's, and that towards the corpus's, each
without the row's own share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import cut, lookup_join, packed
from tabreg.llm.textnum import working
from tabreg.sources.scratch import drop, keep, scoped

#: Bound on the labelled rows of a language that the character model is fitted on, in expectation.
FIT_ROWS = 20_000
#: Share of declared languages taken to be right; the rest falls on the others evenly.
DECLARED_RIGHT = 0.9
#: Rows that a smoothing level counts for; characters a text counts for at most.
SMOOTHING = 5.0
TEXT_CHARS = 400
#: Least posterior, and least gain per character (nats) over unordered letters, of an accepted row.
LEAST_POSTERIOR = 0.5
LEAST_ORDER = 0.0
_SYMBOLS = 64


def _symbols() -> np.ndarray:
    """Bytes to 64 classes: a-z, the upper bytes by their low bits, and one for all else."""
    out = np.zeros(256, np.int32)
    out[97:123] = np.arange(1, 27)
    out[128:] = 27 + (np.arange(128, 256) & 31)
    return out


_CLASS = _symbols()
#: Characters whose trigrams are held at a time; a longer text is taken alone.
SLICE_CHARS = 400_000


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part, chars = [], 0
    for t in texts:
        if part and chars + len(t) > SLICE_CHARS:
            yield part
            part, chars = [], 0
        part.append(t)
        chars += len(t)
    if part:
        yield part


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, code) of the overlapping three symbols that end in a letter; runs of other marks count as one."""
    working("language_id")
    raw = [f" {t.lower()} ".encode() for t in texts]
    doc = np.repeat(np.arange(len(raw), dtype=np.int32), [len(r) for r in raw])
    s = _CLASS[np.frombuffer(b"".join(raw), np.uint8)]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] > 0) | (s[:-1] > 0)
    s, doc = s[keep], doc[keep]
    ok = (doc[2:] == doc[:-2]) & (s[2:] > 0)
    return doc[2:][ok], (s[:-2] * _SYMBOLS**2 + s[1:-1] * _SYMBOLS + s[2:])[ok]


def fit_text_model(rows: DataFrame, text: str, label: str, key: str, languages: list[str],
                   fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Log probabilities (1 + languages, 64^3) of a symbol after two others; row 0: of the symbol alone.

    A language of at most ``fit_rows`` rows is fitted on all of them, one of
    more on those whose hash of ``key`` and text falls into a share that holds
    ``fit_rows`` rows in expectation. So how many rows the others have does not
    matter. Null texts and rows of other labels are left out. The counts are
    one fixed-size array per language.
    """
    rows = rows.where(F.col(label).isin(languages) & F.col(text).isNotNull())
    many = {r[label]: r["count"] for r in rows.groupBy(label).count().collect() if r["count"] > fit_rows}
    draw = F.xxhash64(F.col(key), F.col(text), F.lit("fit"))
    skip = F.lit(False)
    for name, n in sorted(many.items()):
        skip = skip | ((F.col(label) == name) & (F.pmod(draw, F.lit(n)) >= fit_rows))
    rows = rows.where(~skip)

    def counts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(languages), _SYMBOLS**3), np.int64)
        for part in parts:
            for lang, group in part.groupby("label"):
                for texts in _slices(group["text"].tolist()):
                    sums[languages.index(lang)] += np.bincount(_trigrams(texts)[1], minlength=_SYMBOLS**3)
        for i, row in enumerate(sums):
            at = np.flatnonzero(row)
            yield pd.DataFrame({"lang": i, "code": at, "n": row[at]})

    found = (rows.select(F.col(label).alias("label"), F.col(text).alias("text")).mapInPandas(counts, "lang int, code int, n long")
             .groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas())  # 64^3 rows a language at most
    c = np.zeros((len(languages), _SYMBOLS**3))
    c[found["lang"], found["code"]] = found["n"]
    alone = c.sum(0).reshape(-1, _SYMBOLS).sum(0) + 1.0
    alone /= alone.sum()
    c = c.reshape(len(languages), -1, _SYMBOLS)
    after = (c + 2.0 * alone) / (c.sum(2, keepdims=True) + 2.0)
    return np.log(np.concatenate([np.broadcast_to(alone, (1, _SYMBOLS**2, _SYMBOLS)), after])).reshape(-1, _SYMBOLS**3).astype(np.float32)


_TAGS = re.compile(r"<(script|style|nav)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)


def _scored(texts, table: np.ndarray, html: bool) -> np.ndarray:
    """A row for each text: letters; mean log likelihood per letter alone and in each language; each
    language's probability by the text alone (zeros without letters)."""
    out = [np.zeros((0, 2 * len(table)))]
    for part in _slices([t or "" for t in texts]):
        part = [_TAGS.sub(" ", t) for t in part] if html else part
        doc, code = _trigrams(part)
        n = np.bincount(doc, minlength=len(part)).astype(float)[:, None]
        mean = np.stack([np.bincount(doc, row[code], len(part)) for row in table], 1) / np.maximum(n, 1)
        told = np.exp(_weighted(n, mean) - _weighted(n, mean).max(1, keepdims=True, initial=-np.inf))
        out.append(np.concatenate([n, mean, told / told.sum(1, keepdims=True) * (n > 0)], 1))
    return np.concatenate(out)


def text_scores(text: Column, model, html: bool = False) -> Column:
    """array<double>: what ``_scored`` gives."""
    @F.pandas_udf("array<double>")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_scored(texts, model.value, html)))

    return scores(text)


def _weighted(n: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Log likelihood of a text in each language; a long text counts as TEXT_CHARS letters."""
    return np.minimum(n, TEXT_CHARS) * mean[:, 1:]


def _fused(model, html: bool, languages: list[str], total: list[float], n_suffixes: int):
    """A function of the evidence (text, sums of the row's host, domain and suffix, declared language)."""
    k = len(languages)
    everything = np.array(total) + 1.0
    wrong = (1 - DECLARED_RIGHT) / max(1, k - 1)

    @F.pandas_udf("id string, posterior double, text string, accepted boolean")
    def fuse(texts: pd.Series, host: pd.Series, domain: pd.Series, suffix: pd.Series, declared: pd.Series) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame({"id": [], "posterior": [], "text": [], "accepted": []})
        scores = _scored(texts, model.value, html)
        n, mean, own = scores[:, :1], scores[:, 1:2 + k], scores[:, 2 + k:]
        rest = [np.maximum(np.stack(level) - own, 0.0) for level in (suffix, domain, host)]  # without the row's share
        prior = everything / everything.sum()
        for level in rest:
            prior = (level + SMOOTHING * prior) / (level.sum(1, keepdims=True) + SMOOTHING)
        markup = np.zeros((len(n), k))
        for i, name in enumerate(languages):
            markup[(declared == name).to_numpy()] = np.log(np.where(np.arange(k) == i, DECLARED_RIGHT, wrong))
        address = np.log((rest[0] + SMOOTHING / n_suffixes) / (np.array(total) + SMOOTHING))
        text = _weighted(n, mean)
        score = text + np.log(prior) + markup + address
        best, by_text = score.argmax(1), text.argmax(1)
        posterior = 1 / np.exp(score - score.max(1, keepdims=True)).sum(1)
        ordered = mean[:, 1:].max(1) - mean[:, 0]
        names = np.array(languages, object)
        return pd.DataFrame({
            "id": names[best], "posterior": posterior, "text": np.where(n[:, 0] > 0, names[by_text], None),
            "accepted": (n[:, 0] > 0) & (ordered > LEAST_ORDER) & (posterior >= LEAST_POSTERIOR)})

    return fuse


def _code(declared: Column) -> Column:
    """The language code of a declaration: two or three letters, or empty."""
    return F.lower(F.regexp_extract(F.coalesce(declared, F.lit("")), r"^\s*([A-Za-z]{2,3})", 1))


@scoped
def identify(rows: DataFrame, model, languages: list[str], text: str, declared: Column, host: Column,
             html: bool = False) -> DataFrame:
    """All rows and columns of ``rows`` (none of theirs may begin with _lang_) plus _lang_id, _lang_posterior, _lang_text, _lang_accepted,
    _lang_declared, _lang_host and _lang_suffix.

    ``declared`` is a language code (regions after - or _ are ignored; unknown
    codes and nulls say nothing); ``host`` a host or source name (null: the
    empty host). A row is accepted if it has letters, its text is likelier in
    its language's order than as unordered letters, and the posterior is
    LEAST_POSTERIOR or more. Null and empty texts have no letters: their
    language follows from the other evidence, and they are rejected. Equal
    scores go to the first language. An empty table gives no rows.
    """
    k = len(languages)
    name = F.lower(F.coalesce(host, F.lit("")))
    labels = F.split(name, r"\.")
    rows = rows.withColumns({
        "_lang_declared": _code(declared),
        "_lang_host": name, "_lang_domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "_lang_suffix": F.when(F.size(labels) > 1, F.element_at(labels, -1)).otherwise("")})

    # soft counts of each level, from all rows
    sums = [F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]
    hosts = cut(rows.select("_lang_host", "_lang_domain", "_lang_suffix", text_scores(F.col(text), model, html).alias("_lang_scores"))
                .select("_lang_host", "_lang_domain", "_lang_suffix", *[F.col("_lang_scores")[2 + k + i].alias(f"s{i}") for i in range(k)])
                .groupBy("_lang_host", "_lang_domain", "_lang_suffix").agg(*sums), "lang-hosts")
    domains = cut(hosts.groupBy("_lang_domain").agg(*sums), "lang-domains")
    suffixes = cut(hosts.groupBy("_lang_suffix").agg(*sums), "lang-suffixes")
    total = suffixes.agg(*sums).first()
    total = [float(total[i] or 0.0) for i in range(k)]

    def named(level: DataFrame, at: str, *keys: str) -> DataFrame:
        return level.select(*keys, F.array(*[F.col(f"s{i}") for i in range(k)]).alias(f"_lang_at_{at}"))

    levels = lookup_join(named(hosts, "host", "_lang_host", "_lang_domain", "_lang_suffix"),
                         named(domains, "domain", "_lang_domain"), ["_lang_domain"], domains.count())
    levels = lookup_join(levels, named(suffixes, "suffix", "_lang_suffix"), ["_lang_suffix"], n_suffixes := suffixes.count())
    levels = cut(levels.drop("_lang_domain", "_lang_suffix"), "lang-levels")
    drop(hosts, domains, suffixes)
    keep(levels)
    rows = lookup_join(rows, levels, ["_lang_host"], levels.count())
    fuse = _fused(model, html, languages, total, max(1, n_suffixes))  # one Python step a task, so one worker
    out = rows.withColumn("_lang_f", fuse(text, "_lang_at_host", "_lang_at_domain", "_lang_at_suffix", "_lang_declared"))
    out = out.withColumns({f"_lang_{c}": F.col(f"_lang_f.{c}") for c in ("id", "posterior", "text", "accepted")})
    return out.drop("_lang_f", "_lang_domain", "_lang_at_host", "_lang_at_domain", "_lang_at_suffix")


def languages_of(rows: DataFrame, label: str, most: int = 200) -> list[str]:
    """The ``most`` most frequent labels, in alphabetical order."""
    found = rows.where(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label).limit(most).collect()
    return sorted(r[label] for r in found)


def fitted_languages(model: np.ndarray, languages: list[str]) -> list[str]:
    """The languages that had a letter to fit; the row of another equals the row of the symbol alone."""
    return [name for name, row in zip(languages, model[1:]) if not np.array_equal(row, model[0])]


def identify_pages(pages: DataFrame, labelled: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """page_id, language, posterior, text_language, declared, host, suffix, accepted for every page.

    A page with letters that declares a language which occurs among the labels
    but has no model is accepted: nothing speaks against what it declares.
    """
    languages = languages_of(labelled, "lang")
    fit = fit_text_model(labelled, "text", "lang", "doc_id", languages, fit_rows)
    model = pages.sparkSession.sparkContext.broadcast(fit)
    fitted = fitted_languages(fit, languages)
    others = labelled.where(F.col("lang").isNotNull() & ~F.col("lang").isin(fitted)).select(_code(F.col("lang")).alias("code")).distinct()
    unfitted = [r["code"] for r in others.where("code != ''").collect() if r["code"] not in fitted]  # of 26^2 + 26^3 codes
    declared = F.regexp_extract(F.coalesce(F.col("html"), F.lit("")), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z_-]+)", 1)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[^:/?#]*://([^/?#:]*)", 1))
    rows = pages.select("page_id", "html", declared.alias("declared"), host.alias("host"))
    out = identify(rows, model, languages, "html", F.col("declared"), F.col("host"), html=True)
    accepted = F.col("_lang_accepted") | (F.col("_lang_text").isNotNull() & F.col("_lang_declared").isin(unfitted))
    return out.select("page_id", F.col("_lang_id").alias("language"), F.col("_lang_posterior").alias("posterior"),
                      F.col("_lang_text").alias("text_language"), F.col("_lang_declared").alias("declared"),
                      F.col("_lang_host").alias("host"), F.col("_lang_suffix").alias("suffix"), accepted.alias("accepted"))


def keep_identified(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The accepted rows of documents with their columns; ``lang`` is taken as declared, ``source`` as the host.

    A row with letters whose ``lang`` has no model (beyond the most frequent
    ones, or never with letters) is kept: its text can't be held against its
    own language. Without any label no language is known and every row is kept.
    """
    languages = languages_of(docs, "lang")
    if not languages:
        return docs
    fit = fit_text_model(docs, "text", "lang", "doc_id", languages, fit_rows)
    model = docs.sparkSession.sparkContext.broadcast(fit)
    lang = F.col("_doc.lang")
    out = identify(packed(docs), model, languages, "_doc.text", lang, F.col("_doc.source"))
    unfitted = lang.isNotNull() & ~lang.isin(fitted_languages(fit, languages))
    return out.where(F.col("_lang_accepted") | (unfitted & F.col("_lang_text").isNotNull())).select("_doc.*")
