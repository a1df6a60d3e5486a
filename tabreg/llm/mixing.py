"""Mixing sources to target weights by iterative proportional fitting.

Token counts by cell (source, language, topic) are raked until every margin
has its target share; a row's weight is its cell's raked share over its share
in the corpus. Rows are then drawn with probabilities proportional to the
weights, scaled to a token budget. Built from SQL functions only; rows are
never grouped, sorted or shuffled, only their cells' counts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.functions.hashing import hash_unit
from tabreg.llm.common import cut, lookup_join, packed
from tabreg.sources.scratch import drop, keep, scoped

#: Sweeps end when no margin is off its target by more than this share of it, or after so many.
TOLERANCE = 1e-4
MOST_SWEEPS = 500
KEEP_SHARE = 0.5
#: Target shares of a margin are its observed shares to this power, rescaled: 1 keeps them, 0 makes them equal.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.5}
_TOKENS = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Words between ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(_TOKENS)), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic from marks in the text: legal, contact, table, short or prose."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return (F.when(low.contains("license") | low.contains("copyright"), "legal").when(low.contains("@"), "contact")
            .when(low.contains("|"), "table").when(F.length(low) < 400, "short").otherwise("prose"))


def _shares(cells: DataFrame, dim: str, power: float, fixed: dict | None) -> DataFrame:
    """dim, share: the target of one margin, over the values that occur."""
    margin = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("tokens"))
    if fixed is None:
        raw = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(float(power)))).otherwise(0.0)
    else:
        raw = F.lit(0.0)
        for value, share in fixed.items():
            raw = F.when(F.col(dim).eqNullSafe(F.lit(value)), F.lit(float(share))).otherwise(raw)
        raw = F.when(F.col("tokens") > 0, raw).otherwise(0.0)
    margin = cut(margin.select(dim, raw.alias("raw")), "mix-target")
    total = margin.agg(F.sum("raw")).first()[0] or 1.0
    return margin.select(dim, (F.col("raw") / total).alias("share"))


def raked_cells(cells: DataFrame, dims: list[str], powers: dict, fixed: dict, most_sweeps: int = MOST_SWEEPS) -> tuple[DataFrame, float]:
    """(dims, tokens, weight (raked share over observed share; null tokens and empty cells: 0); the error left).

    Sweeps go on until no margin was off by more than ``TOLERANCE`` of its
    target. Targets that no weights can meet together (a source of one
    language, say) never get there: if ten sweeps have not made the error a
    tenth smaller, or after ``most_sweeps``, it ends with the error that is left.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    targets = {}
    for d in dims:
        t = cut(_shares(cells, d, powers.get(d, 1.0), fixed.get(d)), "mix-target")
        targets[d] = (t, t.count())
    fitted = cut(cells.select(*dims, "tokens", (F.col("tokens") / F.lit(total)).alias("w")), "mix-cells")
    errors = []
    while len(errors) < most_sweeps:
        swept = fitted.select(*dims, "tokens", "w", F.lit(0.0).alias("off"))
        for d in dims:
            target, n = targets[d]
            margin = swept.groupBy(d).agg(F.sum("w").alias("m"))
            factor = lookup_join(margin, target, [d], n).select(
                d, F.when(F.col("m") > 0, F.col("share") / F.col("m")).otherwise(0.0).alias("factor"),
                F.when((F.col("m") > 0) & (F.col("share") > 0), F.abs(F.col("m") / F.col("share") - 1)).otherwise(0.0).alias("error"))
            swept = lookup_join(swept, factor, [d], n).select(*dims, "tokens", (F.col("w") * F.col("factor")).alias("w"),
                                                             F.greatest("off", "error").alias("off"))
        swept = cut(swept, "mix-cells")
        drop(fitted)
        fitted = swept
        errors.append(fitted.agg(F.max("off")).first()[0] or 0.0)
        if errors[-1] <= TOLERANCE or (len(errors) > 10 and errors[-1] > 0.9 * errors[-11]):
            break
    seen = F.col("tokens") / F.lit(total)
    out = fitted.select(*dims, "tokens", F.when(F.col("tokens") > 0, F.col("w") / seen).otherwise(0.0).alias("weight"))
    return out, errors[-1] if errors else 0.0


def _scale(cells: DataFrame, budget: float) -> float:
    """c with sum(tokens * min(1, c * weight)) = budget, or all rows of positive weight if they are fewer."""
    scale = 0.0
    while True:
        full = F.col("weight") * F.lit(scale) >= 1
        row = cells.where("weight > 0").agg(F.sum(F.when(full, F.col("tokens"))).alias("full"),
                                            F.sum(F.when(~full, F.col("tokens") * F.col("weight"))).alias("open")).first()
        if not row["open"]:
            return scale
        new = max(0.0, budget - (row["full"] or 0)) / row["open"]
        if new <= scale * (1 + 1e-12):
            return scale
        scale = new


@scoped
def mix(docs: DataFrame, dims: dict[str, Column], key: str = "doc_id", text: str = "text",
        powers: dict[str, float] | None = None, targets: dict[str, dict] | None = None,
        keep_share: float = KEEP_SHARE, most_sweeps: int = MOST_SWEEPS, seed: str = "mix") -> DataFrame:
    """All rows of ``docs`` with their columns (none of theirs may begin with _mix_) and _mix_<dim>, _mix_tokens,
    _mix_weight, _mix_probability, _mix_sampled, _mix_error.

    ``dims``: {margin: Column}. A margin's target is ``targets[margin]``
    ({value: share}; values not named get none) or its observed token shares to
    the power ``powers[margin]``. A row is sampled if a hash of ``key`` and
    ``seed`` falls below min(1, c * weight), c set so that ``keep_share`` of
    all tokens is expected. Rows with equal keys are sampled alike; nulls are
    a value of their own in a margin; a null key is hashed as the empty text.
    A row without tokens has the weight of its cell (0 if the whole cell has
    none). _mix_error is the largest share of its target by which a margin was
    still off in the last sweep. An empty table gives no rows. Columns of other
    names stay as they are.
    """
    names = [f"_mix_{d}" for d in dims]
    rows = docs.withColumns({**{f"_mix_{d}": c for d, c in dims.items()}, "_mix_tokens": token_count(F.col(text))})
    cells = cut(rows.groupBy(*names).agg(F.sum("_mix_tokens").alias("tokens")), "mix-counts")
    powers = {f"_mix_{d}": p for d, p in (POWERS if powers is None else powers).items()}
    fixed = {f"_mix_{d}": t for d, t in (targets or {}).items()}
    raked, error = raked_cells(cells, names, powers, fixed, most_sweeps)
    weights = cut(raked, "mix-weights")
    keep(weights)
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    scale = _scale(weights, keep_share * total)
    small = weights.select(*names, F.col("weight").alias("_mix_weight"),
                           F.least(F.lit(1.0), F.col("weight") * F.lit(scale)).alias("_mix_probability"))
    out = lookup_join(rows, small, names, weights.count())
    draw = hash_unit(key, salt=seed)
    return out.withColumn("_mix_sampled", draw < F.col("_mix_probability")).withColumn("_mix_error", F.lit(error))


def keep_sampled(docs: DataFrame) -> DataFrame:
    """The sampled rows of documents, with their columns."""
    rows = mix(packed(docs), document_dims("_doc.source", "_doc.lang", "_doc.text"), "_doc.doc_id", "_doc.text")
    return rows.where("_mix_sampled").select("_doc.*")


def document_dims(source: str = "source", lang: str = "lang", text: str = "text") -> dict[str, Column]:
    return {"source": F.col(source), "lang": F.col(lang), "topic": topic_of(F.col(text))}


def oracle_sql(keep_share: float = KEEP_SHARE, sweeps: int = 40, steps: int = 12) -> str:
    """DuckDB SQL for ``mix`` over documents with the default powers, for tables on which it ends within ``sweeps`` sweeps."""
    topic = """case when contains(low, 'license') or contains(low, 'copyright') then 'legal' when contains(low, '@') then 'contact'
 when contains(low, '|') then 'table' when length(low) < 400 then 'short' else 'prose' end"""
    ctes = [f"""base as (select doc_id, source, lang, {topic} as topic, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as tokens
 from (select *, lower(coalesce(text, '')) as low from documents))""",
            "c0 as materialized (select source, lang, topic, sum(tokens)::double as tokens from base group by all)",
            "tot as materialized (select sum(tokens) as total from c0)",
            "f0 as materialized (select source, lang, topic, tokens, tokens / total as w from c0, tot)"]
    for d, p in POWERS.items():
        ctes.append(f"t_{d} as materialized (select {d}, raw / sum(raw) over () as share from "
                    f"(select {d}, case when sum(tokens) > 0 then pow(sum(tokens), {p}) else 0 end as raw from c0 group by {d}))")
    n, errors, ends = 0, [], []
    for k in range(sweeps):
        off = []
        for d in POWERS:
            ctes.append(f"m{n} as materialized (select m.{d}, m.m, t.share from (select {d}, sum(w) as m from f{n} group by {d}) m "
                        f"join t_{d} t on m.{d} is not distinct from t.{d})")
            off.append(f"(select coalesce(max(abs(m / share - 1)), 0) from m{n} where m > 0 and share > 0)")
            ctes.append(f"f{n + 1} as materialized (select f.source, f.lang, f.topic, f.tokens, f.w * case when m.m > 0 then m.share / m.m else 0 end as w "
                        f"from f{n} f join m{n} m on f.{d} is not distinct from m.{d})")
            n += 1
        errors.append(f"select {k} as k, greatest({', '.join(off)}) as off")
        ends.append(f"select {k} as k, * from f{n}")
    ctes.append(f"stop as materialized (select min(k) as k from ({' union all '.join(errors)}) where off <= {TOLERANCE})")
    ctes.append(f"wt as materialized (select source, lang, topic, tokens, case when tokens > 0 then w / (tokens / total) else 0 end as weight "
                f"from ({' union all '.join(ends)}) join stop using (k), tot)")
    ctes.append("s0 as materialized (select 0.0::double as scale)")
    for i in range(steps):
        ctes.append(f"s{i + 1} as materialized (select coalesce(greatest(any_value(scale), greatest(0, {keep_share} * any_value(total) - "
                    f"coalesce(sum(tokens) filter (weight * scale >= 1), 0)) / sum(tokens * weight) filter (weight * scale < 1)), any_value(scale)) as scale "
                    f"from wt, s{i}, tot where weight > 0)")
    draw = "('0x' || substr(md5(concat_ws('-', 'mix', cast(b.doc_id as varchar))), 1, 8))::bigint / 4294967296.0"
    return (f"with {', '.join(ctes)} select b.doc_id, b.source, b.lang, b.topic, b.tokens, round(weight, 6) as weight, "
            f"round(least(1.0, weight * scale), 6) as probability, {draw} < least(1.0, weight * scale) as sampled "
            f"from base b join wt w on b.source is not distinct from w.source and b.lang is not distinct from w.lang and b.topic = w.topic, s{steps}")
