import zlib

from tabreg.llm import sharding


def brute(rows, n):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    total, start, out, slots = sum(r[1] for r in rows), 0, [], {}
    for key, size, crc in rows:
        shard = min(n - 1, (2 * start + size) * n // (2 * total))
        out.append((key, size, crc, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
        start += size
    return out


def rows_of(docs):
    return [(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()]


def got_of(df):
    return [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def test_equals_brute_force(spark, sf_docs):
    for n, buckets in ((24, None), (3, 7), (1, 2)):
        got = sharding.shard_by_bytes(sf_docs.repartition(5), n, n_buckets=buckets)
        assert order(got_of(got)) == order(brute(rows_of(sf_docs), n))


def test_balance_and_slots(spark, sf_docs):
    got = sharding.shard_by_bytes(sf_docs, 24).collect()
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s in range(24):
        part = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in part] == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / 24) <= largest
    ids = sorted((r.doc_id, r.shard) for r in got)
    assert [s for _, s in ids] == sorted(s for _, s in ids)  # contiguous


def test_odd_rows(spark, odd_docs):
    got = sharding.shard_by_bytes(odd_docs, 4)
    assert order(got_of(got)) == order(brute(rows_of(odd_docs), 4))
    assert sharding.shard_by_bytes(odd_docs.where("false"), 4).count() == 0
    same = spark.createDataFrame([(7, "x")] * 50, "doc_id long, text string")
    assert order(got_of(sharding.shard_by_bytes(same, 5))) == order(brute(rows_of(same), 5))


def texts_of(docs, n):
    """Brute force of the text order, from Spark's hash of each text; copies in key order, nulls first."""
    rows = [(r.h, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()), r.doc_id) for r in docs.selectExpr(
        "doc_id", "text", "xxhash64(coalesce(text, '')) as h").collect()]
    rows.sort(key=lambda r: (*r[:3], r[3] is not None, r[3]))
    total, start, out, slots = sum(r[1] for r in rows), 0, [], {}
    for _, size, crc, key in rows:
        shard = min(n - 1, (2 * start + size) * n // (2 * total))
        out.append((key, size, crc, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
        start += size
    return out


def test_texts_equal_brute_force(spark, sf_docs, odd_docs):
    for n, buckets in ((24, None), (3, 7), (1, 2)):
        got = sharding.shard_texts_by_bytes(sf_docs.repartition(5), n, n_buckets=buckets)
        assert order(got_of(got)) == order(texts_of(sf_docs, n))
    got = sharding.shard_texts_by_bytes(odd_docs, 4)
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert order(got_of(got)) == order(texts_of(odd_docs, 4))
    assert sharding.shard_texts_by_bytes(odd_docs.where("false"), 4).count() == 0


def test_copies_share_a_shard(spark):
    """A third of all rows in one group, many small groups, text keys: only groups on a cut are spread."""
    rows = ([(f"k{i:04d}", "hot " * 20) for i in range(300)] + [(f"c{i:04d}", f"copy {i % 100}") for i in range(400)]
            + [(f"s{i:04d}", f"single text number {i}") for i in range(200)])
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(7)
    got = got_of(sharding.shard_texts_by_bytes(docs, 12))
    assert sorted(got) == sorted(texts_of(docs, 12))
    total, shards = sum(r[1] for r in got), {}
    for _, size, crc, shard, _ in got:
        shards.setdefault((size, crc), set()).add(shard)
    spread = [s for s in shards.values() if len(s) > 1]
    assert len(spread) <= 11 and len(shards) == 301
    hot = max(shards.values(), key=len)
    assert sorted(hot) == list(range(min(hot), max(hot) + 1)) and len(hot) <= 300 * 88 * 12 // total + 2
    for s in range(12):
        assert abs(sum(r[1] for r in got if r[3] == s) - total / 12) <= 88
