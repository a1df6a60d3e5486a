"""Merkle manifest of a table: one digest for all of it, and a proof for each row.

The leaves of each part (a language) form a binary tree in key order, the
roots of the parts another one above them. Trees are built in steps of a few
levels: a group of 2^5 neighbouring nodes gives the next five levels at once.

Proofs come by pointer jumping. A node's path is the list of siblings on the
way to the ancestor it points at; at first that is its parent. Joining nodes
with the ancestors they point at doubles the distance and concatenates the
paths. A node 2^r levels up is asked for 2^r levels more only, so round r
needs the nodes of the levels that 2^r divides: their number shrinks fast, and
while one ancestor serves many leaves, its table is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import cut, lookup_join, numbered, sized
from tabreg.sources.scratch import drop, keep, scoped

#: Levels built in one step; a group has 2^STEP nodes at most.
STEP = 5
#: Fixed value: what stands for a null in a leaf.
NULL = "-"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in front, so that two rows never read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(NULL))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def _height(n: str) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.when(F.col(n) <= 1, 0).otherwise(F.length(F.bin(F.col(n) - 1))).cast("int")


_PAIRS = ("transform(sequence(0, (size({a}) + 1) div 2 - 1), i -> "
          "sha2(concat(get({a}, 2 * i), coalesce(get({a}, 2 * i + 1), '')), 256))")


def _grow(leaves: DataFrame, payload: list[str]) -> tuple[DataFrame, DataFrame, DataFrame, list[DataFrame]]:
    """(leaves with their sibling, inner nodes with theirs, tops, written tables) of trees; the leaves read the first table only.

    ``leaves``: tree, n (leaves of the tree), pos, hash and the payload.
    """
    nodes, inner, tops = leaves.withColumn("height", _height("n")), None, None
    base, first, written = 0, None, []
    while True:
        item = F.struct("pos", "hash", *(payload if base == 0 else []))
        groups = (nodes.groupBy("tree", "height", F.expr(f"shiftright(pos, {STEP})").alias("grp"))
                  .agg(F.sort_array(F.collect_list(item)).alias("items"))
                  .withColumn("low", F.transform("items", lambda x: x["hash"]))
                  .withColumn("levels", F.expr(f"aggregate(sequence(1, {STEP}), array(low), (acc, k) -> "
                                               f"concat(acc, array({_PAIRS.format(a='element_at(acc, -1)')})))")))
        if base == 0:
            groups = cut(groups.select("tree", "height", "grp", "items", "levels"), "merkle-leaves")
            first = groups.select("tree", "height", F.expr(
                "explode(transform(items, (x, i) -> struct(x as item, get(levels[0], i ^ 1) as sib)))").alias("_x"))
            first = first.select("tree", "height", *[F.col(f"_x.item.{c}").alias(c) for c in ("pos", "hash", *payload)],
                                 F.col("_x.sib").alias("sib"))
        else:
            groups = cut(groups.select("tree", "height", "grp", "levels"), "merkle-levels")
        written.append(groups)
        here = (groups.select("tree", "height", "grp", F.posexplode(F.slice("levels", 1, STEP)).alias("up", "line"))
                .where((F.col("up") + base > 0) & (F.col("up") + base < F.col("height")))
                .select("tree", "height", (F.col("up") + base).alias("level"), F.expr(f"shiftleft(grp, {STEP} - up)").alias("at"), "line",
                        F.expr("explode(sequence(0, size(line) - 1))").alias("i"))
                .select("tree", "height", "level", (F.col("at") + F.col("i")).alias("pos"), F.expr("get(line, i ^ 1)").alias("sib")))
        inner = here if inner is None else inner.unionByName(here)
        top = groups.where(F.col("height") <= base + STEP).select("tree", F.expr(f"levels[height - {base}][0]").alias("top"))
        tops = top if tops is None else tops.unionByName(top)
        nodes = groups.where(F.col("height") > base + STEP).select(
            "tree", "height", F.col("grp").alias("pos"), F.expr(f"levels[{STEP}][0]").alias("hash"))
        base += STEP
        if nodes.isEmpty():
            return first, inner, tops, written


def _paths(leaves: DataFrame, inner: DataFrame, tallest: int) -> tuple[DataFrame, list[DataFrame]]:
    """``leaves`` with ``path``: the siblings up to the top, by pointer jumping."""
    step = F.struct((F.col("pos") % 2 == 1).alias("on_left"), F.col("sib").alias("sib"))
    out = leaves.withColumn("path", F.when(F.col("height") > 0, F.array(step)).otherwise(F.array().cast(
        "array<struct<on_left:boolean,sib:string>>"))).drop("sib")
    nodes = cut(inner.withColumn("path", F.array(step)).drop("sib"), "merkle-nodes")
    written, reach = [nodes], 1
    while reach < tallest:
        n = nodes.count()

        def jumped(rows: DataFrame, level: Column) -> DataFrame:
            """Rows that point ``reach`` levels up take over the path of the node there."""
            up = F.least(level + reach, F.col("height"))
            asks = rows.withColumn("_level", up).withColumn("_pos", F.expr(f"shiftright(pos, {reach})"))
            known = nodes.select(F.col("tree").alias("_tree"), F.col("level").alias("_node"), F.col("pos").alias("_at"), F.col("path").alias("_more"))
            joined = asks.join(sized(known, n), (F.col("tree") == F.col("_tree")) & (F.col("_level") == F.col("_node"))
                               & (F.col("_pos") == F.col("_at")), "left")
            return joined.withColumn("path", F.when(F.col("_more").isNull(), F.col("path")).otherwise(F.concat("path", "_more"))).select(*rows.columns)

        out = jumped(out, F.lit(0))
        higher = jumped(nodes.where(F.col("level") % (2 * reach) == 0), F.col("level"))
        reach *= 2
        if reach < tallest:
            nodes = cut(higher, "merkle-nodes")
            written.append(nodes)
    return out, written


def fold(start: Column, path: Column) -> Column:
    """The top digest that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda acc, x: digest(
        F.when(x["sib"].isNull(), acc).when(x["on_left"], F.concat(x["sib"], acc)).otherwise(F.concat(acc, x["sib"]))))


def _forest(leaves: DataFrame, payload: list[str], tallest: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(leaves with path, tops, written tables that the leaves read)."""
    first, inner, tops, groups = _grow(leaves, payload)
    tops = cut(tops, "merkle-tops")
    found, nodes = _paths(first, inner, tallest)
    drop(*groups[1:])
    return found, tops, [groups[0], *nodes]


def manifest(rows: DataFrame, key: str, part: str, columns: list[str], altered: Column | None = None) -> DataFrame:
    """One row per row of ``rows``: key, leaf, altered, subroot, root, path.

    ``leaf`` is the digest of the row's ``columns``, each with its length in
    front (null: ``-``). The leaves of a ``part`` ascend by key (null keys
    first, equal keys by leaf); every two consecutive nodes become the digest
    of their hex digests, a single last one the digest of itself, until one
    is left, the subroot (a lone leaf is its own). Subroots, by part (null first, then
    by UTF-8 bytes), give the root likewise. ``path`` has an element for each
    level up to the root: the sibling, null where there is none, and whether
    it stands on the left. ``altered``: a leaf to carry along, or null.

    Rows equal in everything are leaves of their own. An empty table gives no
    rows. Further columns are not read. Python-free.
    """
    base = cut(rows.select(F.col(key).alias("key"), F.col(part).cast("string").alias("part"),
                           leaf([F.col(c) for c in columns]).alias("hash"),
                           (F.lit(None).cast("string") if altered is None else altered).alias("altered")), "merkle-rows")
    placed = numbered(base, ["key", "hash"], "pos", ["part"])
    drop(base)
    parts = cut(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "merkle-parts")
    trees = numbered(parts, ["part"], "tree")
    drop(parts)
    facts = trees.agg(F.count(F.lit(1)).alias("trees"), F.max(_height("n")).alias("height")).first()
    leaves = lookup_join(placed, trees, ["part"], facts["trees"])
    found, tops, written = _forest(leaves.drop("part"), ["key", "altered"], facts["height"] or 0)

    roots = (tops.join(trees, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("top").alias("hash"),
                                             F.lit(facts["trees"]).cast("long").alias("n")))
    height = (facts["trees"] - 1).bit_length() if facts["trees"] else 0
    above, root, more = _forest(roots, [], height)
    top = root.first()
    above = cut(above.select(F.col("pos").alias("tree"), F.col("hash").alias("subroot"),
                             F.lit(top["top"] if top else None).cast("string").alias("root"), F.col("path").alias("_up")), "merkle-roots")
    drop(placed, trees, tops, root, *more)
    # the last jump: from the subroot to the root
    done = lookup_join(found, above, ["tree"], facts["trees"])
    keep(above, *written)
    return done.select(F.col("key").alias(key), F.col("hash").alias("leaf"), "altered", "subroot", "root",
                       F.concat("path", "_up").alias("path"))


#: Fixed values of the query.
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


@scoped
def verified(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` with each row's proof checked: where 7 divides the crc32 of doc_id, against a
    row whose n_chars is one more (a null one stays)."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    other = leaf([more if c == "n_chars" else F.col(c) for c in COLUMNS])
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    rows = manifest(docs, "doc_id", "lang", COLUMNS, F.when(hit, other))
    rows = rows.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root",
                       digest(F.array_join(F.transform("path", lambda x: x["sib"]), "")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle_sql() -> str:
    """The same by recursive SQL: levels bottom up, then every proof level by level."""
    cols = [f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in COLUMNS]
    other = [x.replace("n_chars", "(n_chars + 1)") if c == "n_chars" else x for c, x in zip(COLUMNS, cols)]
    bits = "case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end"
    crc = ("xor(4294967295::ubigint, list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::ubigint), "
           f"lambda r, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::ubigint[], lambda x, y: {bits}, xor(r, b)), 4294967295::ubigint))")

    def tree(name, leaves, part):
        return f"""{name} as (
            select {part} as t, 0 as lv, pos, h, count(*) over (partition by {part}) as n from {leaves}
            union all
            select t, any_value(lv) + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (any_value(n) + 1) // 2
            from {name} where n > 1 group by t, pos // 2)"""
    return f"""
    with recursive leaf as (
        select *, row_number() over (partition by lang order by doc_id nulls first, h) - 1 as pos from (
            select doc_id, lang, n_chars, sha256({' || '.join(cols)}) as h, sha256({' || '.join(other)}) as h2, {crc} as crc from documents)),
    {tree('nodes', 'leaf', "coalesce('+' || lang, '')")},
    tops as (select t, h, row_number() over (order by t) - 1 as pos from nodes where n = 1),
    {tree('above', '(select t as lang_t, pos, h from tops)', '0')},
    every as (select 't' || t as t, lv, pos, h, n from nodes union all select 'r', lv, pos, h, n from above),
    walk as (
        select doc_id, leaf.h as leaf, tops.h as subroot, tops.pos as top_pos, leaf.pos as pos, 0 as lv, 't' || tops.t as t, tops.t as own,
               case when crc % 7 = 0 and n_chars is not null then h2 else leaf.h end as acc, '' as proof
        from leaf join tops on tops.t = coalesce('+' || lang, '')
        union all
        select w.doc_id, w.leaf, w.subroot, w.top_pos, case when e.n = 1 then w.top_pos else w.pos // 2 end,
               case when e.n = 1 then 0 else w.lv + 1 end, case when e.n = 1 then 'r' else w.t end, w.own,
               case when e.n = 1 then w.acc when s.h is null then sha256(w.acc) when w.pos % 2 = 1 then sha256(s.h || w.acc) else sha256(w.acc || s.h) end,
               case when e.n = 1 then w.proof else w.proof || coalesce(s.h, '') end
        from walk w join every e on e.t = w.t and e.lv = w.lv and e.pos = w.pos
        left join every s on s.t = w.t and s.lv = w.lv and s.pos = xor(w.pos, 1)
        where not (w.t = 'r' and e.n = 1)),
    root as (select h from above where n = 1)
    select doc_id, leaf, subroot, root.h as root, sha256(proof) as proof_sha256, acc as folded_root, acc = root.h as verified
    from walk, root where walk.t = 'r' and walk.lv = (select max(lv) from above)"""
