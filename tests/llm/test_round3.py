"""Operators 11 to 13 against plain computations, and on odd tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from streammart.llm import decontamination, negatives, queries, resampling
from tests.llm.test_operators import CLASHING, ODD, SCHEMA, small_dir  # noqa: F401

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = [
    (1, "w3 w4 w5"),
    (2, "Null-ID é漢🎉"),
    (2, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"),
    (3, None),
    (4, " .,;"),
    (None, "five"),
    (6, "w3 W4, w5"),
    (7, "never seen at all"),
]
NAMES = [*CLASHING, "n_words", "n_hit", "items", "spans", "words", "weight", "rank", "row", "counts", "codes", "text2", "number"]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lowered(text))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("other") for c in NAMES})


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit("other") for c in ("item", "window", "items", "shard")})


def plain_hits(text, tests, width=10):
    """Hit word places and names of items, by comparing at every place."""
    own, hit, found = words(text), set(), set()
    for name, test in tests:
        theirs = words(test)
        lines = {tuple(theirs[i : i + width]) for i in range(max(1, len(theirs) - width + 1))} if theirs else set()
        for line in lines:
            for i in range(len(own) - len(line) + 1):
                if tuple(own[i : i + len(line)]) == line:
                    hit |= set(range(i, i + len(line)))
                    found.add("null" if name is None else str(name))
    return own, hit, sorted(found)


def test_decontamination_on_odd_rows(odd, items):
    rows = decontamination.contaminated(odd, items, carry=["doc_id", "text"]).collect()
    assert len(rows) == len(ODD)
    seen = 0
    for row in rows:
        own, hit, found = plain_hits(row.text if len(row.text or "") < 10_000 else "word", ITEMS)
        if len(row.text or "") < 10_000:
            assert row.n_words == len(own)
        assert row.n_hit == len(hit) and row["items"] == found
        # The spans cover exactly the hit words of the original text.
        inside = [(m.start(), m.end()) for m in WORD.finditer(lowered(row.text))]
        spans = [(s.start, s.end) for s in row.spans]
        assert {i for i, (a, b) in enumerate(inside) if any(s <= a and b <= e for s, e in spans)} == hit
        assert all(any(a == s for a, _ in inside) and any(b == e for _, b in inside) for s, e in spans)
        seen += len(hit)
    assert seen > 30


@pytest.mark.parametrize("limit", [1, 200])
def test_several_automata_find_the_same(odd, items, limit):
    one = decontamination.contaminated(odd, items, carry=["doc_id"])
    many = decontamination.contaminated(odd, items, carry=["doc_id"], shard_bytes=limit)
    key = lambda r: repr(r)
    assert sorted(map(key, one.collect())) == sorted(map(key, many.collect()))


def test_decontamination_carries_columns_and_takes_questions_and_answers(spark, odd):
    tests = spark.createDataFrame([(1, "w3 w4 w5", "w20 w21")], "item_id long, q string, a string")
    got = decontamination.contaminated(odd, tests, item_text=("q", "a"))
    assert set(odd.columns) | {"n_words", "n_hit", "items", "spans"} == set(got.columns)
    assert {r.n_hit for r in got.filter("doc_id in (8, 9, 10)").collect()} == {5}
    assert {r.row for r in got.collect()} == {"other"}


def test_decontamination_empty(spark, odd, items):
    none = decontamination.digests(spark, odd, items.limit(0)).collect()
    assert len(none) == len(ODD) and not any(r.contaminated for r in none)
    assert decontamination.digests(spark, odd.limit(0), items).collect() == []
    assert {r.items_sha256 for r in none} == {hashlib.sha256(b"").hexdigest()}


def grams(text):
    own = words(text)
    return [" ".join(own[i : i + n]) for n in (1, 2, 3) for i in range(len(own) - n + 1)]


def plain_resampling(docs, tests):
    """(doc_id, n_features, weight, score, rank) for (doc_id, text) rows."""
    def buckets(text):
        return [zlib.crc32(g.encode()) % 10000 for g in grams(text)]

    own = [buckets(t) for _, t in docs]
    s, t = collections.Counter(b for x in own for b in x), collections.Counter(b for x in tests for b in buckets(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for (doc_id, text), x in zip(docs, own):
        h = int(hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in x)
        rows.append([doc_id, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = [r for r in rows if r[5] >= 20]
    for n, r in enumerate(sorted(able, key=lambda r: (-r[3], r[0] is None, r[0] or 0))[: 5 * len(able) // 100]):
        r[4] = n + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_resampling(spark, small_dir):  # noqa: F811
    docs = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    tests = [r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    got = queries.REGISTRY["op12_resampling"](spark, small_dir)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    want = plain_resampling(docs, tests)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(r[4] is not None for r in want) > 3


def test_resampling_of_odd_rows_and_ties(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(25)) for _ in range(60)]
    docs = [(i // 2, texts[i // 2]) for i in range(100)] + [(r[0], r[1]) for r in ODD if len(r[1] or "") < 10_000] + [(None, texts[3])] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("other") for c in NAMES})
    tests = spark.createDataFrame([(1, texts[0]), (2, None), (3, "")], "item_id long, text string")
    got = resampling.digests(spark, df, tests).collect()
    assert sorted(map(tuple, got), key=repr) == plain_resampling(docs, [texts[0], None, ""])
    whole = resampling.resampled(df, tests, percent=50)
    assert set(whole.columns) == set(df.columns) | {"n_features", "score"}
    assert whole.filter("rank is not null").filter("length(text) > 20").count() == sum(len(words(t)) >= 20 for _, t in docs) // 2


def test_resampling_reads_long_texts_and_empty_tables(spark, odd):
    tests = spark.createDataFrame([(1, "word word")], "item_id long, text string")
    rows = {r.doc_id: r for r in resampling.digests(spark, odd, tests).collect()}
    assert rows[5].n_features == 3 * 40_001 - 3
    assert rows[3].weight == rows[4].weight == 0 and rows[4].rank is None
    assert resampling.digests(spark, odd.limit(0), tests).collect() == []
    assert len(resampling.digests(spark, odd, tests.limit(0)).collect()) == len(ODD)


def test_ranks_are_gapless_over_several_ranges(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("score"))
    from streammart.llm.ranking import ranked

    got = ranked(rows, [-F.col("score")], "id").join(rows, "id").orderBy("rank").collect()
    assert [r.rank for r in got] == list(range(1, 1001))
    assert [r.score for r in got] == sorted((r.score for r in got), reverse=True)


def plain_negatives(rows):
    """Rows of the contract by comparing everything; rows are (vec_id, vector, label)."""
    use = []
    for i, v, label in rows:
        if None in (i, label) or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for n, (i, q, label) in enumerate(use):
        if i % 100:
            continue
        others = [(-sum(a * b for a, b in zip(q, w)), j, kind == label) for m, (j, w, kind) in enumerate(use) if m != n]
        for p, j, _ in sorted(o for o in others if o[2])[:5]:
            fit = sorted(o[:2] for o in others if not o[2] and 30 * -p <= 100 * -o[0] <= 90 * -p)[:10]
            out += [(i, j, k + 1, m, -p, -s) for k, (s, m) in enumerate(fit)]
    return sorted(out)


EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def mined(spark, rows, **how):
    df = spark.createDataFrame(rows, EMBEDDINGS).withColumns({c: F.lit("x") for c in ("score", "rank", "seq", "chunk", "number", "vector")})
    got = negatives.mined(df, **how)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_hard_negatives_in_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(1200):
        v = centres[i % 6] + 0.3 * rng.normal(size=12)
        rows.append((i, [float(x) for x in (v / np.linalg.norm(v))], int(i % 4)))
    rows += [rows[100], rows[200], (300, rows[7][1], 2), (2000, rows[9][1], 1), (2100, rows[9][1], 1), (2101, rows[9][1], 3)]
    rows += [(2200, None, 1), (2300, rows[1][1], None), (2400, [float("nan")] * 12, 1), (2500, [None] * 12, 1), (2600, [float("inf")] * 12, 2), (None, rows[2][1], 1)]
    rows += [(2700, rows[11][1][:5], 2), (2800, [], 1), (2900, [-x for x in rows[13][1]], 9)]
    for name, n in (("BLOCK_ROWS", 64), ("BLOCKS_PER_PART", 4), ("BLOCKS_PER_CHUNK", 3), ("BLOCKS_PER_PAGE", 5)):
        monkeypatch.setattr(negatives, name, n)
    want = plain_negatives(rows)
    assert len(want) > 300
    assert mined(spark, rows) == want


def test_hard_negatives_of_large_numbers_ties_and_nothing(spark):
    big = [(i * 50, [3e6 * (1 + i % 3), 4e6, float(i % 2)], i % 3) for i in range(40)]
    assert mined(spark, big) == plain_negatives(big) and mined(spark, big)
    same = [(i * 20, [0.5, 0.5], i % 2) for i in range(60)] + [(5 + i, [0.2, 0.2], 3) for i in range(30)]
    assert mined(spark, same) == plain_negatives(same) and mined(spark, same)
    assert mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, []) == []
    assert mined(spark, [(100, None, 1)]) == []


def test_zone_maps_spare_blocks(spark, monkeypatch):
    """On clustered vectors most blocks are never read for an anchor."""
    rng = np.random.default_rng(4)
    centres = np.eye(16)
    rows = [(i, [float(x) for x in centres[i % 16] + 0.02 * rng.normal(size=16)], int(i % 10)) for i in range(3200)]
    for name, n in (("BLOCK_ROWS", 100), ("BLOCKS_PER_PART", 8)):
        monkeypatch.setattr(negatives, name, n)
    blocks, dims = negatives.blocks_of(spark.createDataFrame(rows, EMBEDDINGS))
    anchors = negatives.anchors_of(blocks, dims, 100).withColumn("bar", F.lit(60_000).cast("long"))
    n, pairs = blocks.count(), negatives.chosen(anchors, blocks, dims, negatives.may_be_positive).count()
    assert 0 < pairs < 0.3 * n * anchors.count()


def test_hilbert_neighbours_are_adjacent_cells():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    order = np.argsort(negatives.hilbert(cells, 3))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_they_are_registered():
    assert {"op11_decontamination", "op12_resampling", "op13_hard_negatives"} <= set(entry.queries())
    assert {"op11_decontamination", "op13_hard_negatives"} <= set(entry.oracle_sql())
