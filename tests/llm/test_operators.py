"""The ten operators against plain computations, and on odd tables."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from streammart.llm import bpe, exactdup, fingerprints, html, langid, mixing, neardup, pii, queries, sharding, toxicity
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 40_000 + "a" * 300_000
WORDS = [f"w{i}" for i in range(60)]
ODD = [
    (1, "Hello  World of five words", "en", "a", 5),
    (1, "Hello  World of five words", "en", "a", 5),
    (2, "hello world OF five words", None, None, None),
    (3, "", "en", "b", 0),
    (4, None, None, "a", None),
    (5, LONG, "en", "c", len(LONG)),
    (None, "null id é漢🎉 1.2.3.4 +1 (555) 123-4567", "fr", "a", 1),
    (None, None, None, None, None),
    (7, " \t\n", "en", "d", 3),
    (8, " ".join(WORDS), "en", "a", 9),
    (9, " ".join(WORDS[:-1] + ["x"]), "en", "a", 9),
    (10, " ".join(WORDS[:-1]), "de", "a", 9),
    (11, "HelloWorldoffivewords", "en", "a", 2),
]
CLASHING = ["ids", "starts", "decoded_bytes", "row_id", "key", "n", "kept", "score", "slot", "bucket", "part", "size", "code"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({c: F.lit("other") for c in CLASHING})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="module")
def small_dir():
    return "/root/testdata/sf0.001"


def result(name, spark, folder):
    return queries.REGISTRY[name](spark, folder).collect()


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert set(queries.REGISTRY) <= names and "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.REGISTRY) == list(range(1, 14))


def check_bpe(rows, texts):
    encoding = plain.tiktoken_encoding()
    for row in rows:
        text = texts[row.doc_id] or ""
        ids = encoding.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == plain.sha(",".join(map(str, ids)).encode())
        assert row.decoded_sha256 == plain.sha(text.encode())


def test_bpe(spark, small_dir, texts):
    rows = result("op1_byte_bpe", spark, small_dir)
    assert len(rows) == len(texts)
    check_bpe(rows, texts)


def test_bpe_odd(spark, odd, empty):
    named = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_bpe(bpe.digests(spark, named).collect(), {r[0]: r[1] for r in ODD})
    assert bpe.digests(spark, odd).count() == len(ODD)
    assert bpe.digests(spark, empty).collect() == []


def test_bpe_offsets_and_split_characters(spark):
    ranks, pattern = bpe.multi_50k()
    df = spark.createDataFrame([(1, "ab 🎉漢字 x")], "doc_id long, text string")
    row = bpe.encode(df, ranks, pattern, offsets=True).collect()[0]
    assert len(row.ids) == len(row.starts) == len(row.ends)
    assert row.starts[0] == 0 and row.ends[-1] == len("ab 🎉漢字 x")
    assert all(a < b for a, b in zip(row.starts, row.ends))
    coder = bpe.codec(ranks, pattern)
    whole = [i for i, t in coder.tokens.items() if t == "漢".encode()[:1]][0]
    cut = bpe.decode(spark.createDataFrame([([whole],), (None,)], "ids array<int>"), ranks, pattern).collect()
    assert [r.decoded for r in cut] == ["�", ""] and bytes(cut[0].decoded_bytes) == "漢".encode()[:1]


def check_pii(rows, texts):
    for row in rows:
        spans = plain.base_pii(texts[row.doc_id] or "")
        assert row.base_sha256 == plain.sha(",".join(spans).encode())
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s.startswith(k) for s in spans) for k in pii.KINDS]
        assert set(spans) <= set(row.spans.split(",")) | {""}
        assert len([s for s in row.spans.split(",") if s]) == len(spans) + row.n_added


def test_pii(spark, small_dir, texts):
    check_pii(result("op2_pii", spark, small_dir), texts)


def test_pii_odd(spark, odd, empty):
    named = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_pii(pii.digests(spark, named).collect(), {r[0]: r[1] for r in ODD})
    assert pii.digests(spark, odd).count() == len(ODD)
    assert pii.digests(spark, empty).collect() == []


@pytest.mark.parametrize(
    "text",
    [
        "a@b@c.com x.y@z.de.x@q.org @.@ a@b. ++a%b@c-d.e",
        "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004 1.2.3 99999999.1.1.1",
        "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 1 2 3",
        "+1 (555) 123-4567 + 12 +49.30.1234567890123456 +1 2",
    ],
)
def test_pii_patterns(text):
    assert [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in pii.base_spans(text)] == plain.base_pii(text)


def test_pii_long_runs_take_linear_time():
    assert pii.base_spans("a" * 400_000 + "@" + "1" * 400_000) == []
    assert pii.base_spans("1." * 100_000)[:1] == [(1, 0, 7)]


def test_pii_bare_handles():
    spans = pii.base_spans("x jane.doe@x.org, support@x.org, a1.b@x.org")
    text = "x jane.doe@x.org, support@x.org, a1.b@x.org (Jane.Doe) support jane.doe, a1.b jane.doe.x"
    assert [text[s:e] for s, e in pii.handles(text, spans)] == ["Jane.Doe", "jane.doe"]
    assert pii.handles(text, []) == [] and pii.handles("", spans) == []


def test_pii_handles_are_found_at_every_repeat(spark):
    field = pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    for text, times in (("Write to jane.doe@x.org. Ask Jane.Doe, or jane.doe.", 2), ("jane.doe@x.org " + "said, Jane.Doe then " * 200, 200)):
        base = pii.base_spans(text)
        added = field.more_spans(text, base)
        assert len(base) == 1 and len(added) == times
        assert {text[s:e].lower() for _, s, e in added} == {"jane.doe"} and {k for k, _, _ in added} == {0}
    words = "Mail support@x.org: support is here, as is jane.doe"
    assert field.more_spans(words, pii.base_spans(words)) == []


def test_pii_skip_edges_carry_labels(spark, small_dir):
    # Both tokens are cards for themselves, but the base pattern takes them as one number of 32 digits.
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = pii.train(docs)
    text = "pay 4465758382889437 now, then 4465758382889437 4465758382889437 again"
    base = pii.base_spans(text)
    assert len(base) == 1
    assert [text[s:e] for _, s, e in field.more_spans(text, base)] == ["4465758382889437"] * 2


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>One<p>Two <b>bold</b>\n text<br>line", "One\n\nTwo bold text\nline"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>", "- a\n- b\n  3. x\n  4. y"),
        ("<table><tr><th>Name<th>N<tr><td>Apple<td>12</table>", "Name   N\nApple  12"),
        ("<table><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
        ("<div hidden>no</div><i style='display: none'>no</i>a<script>var x='</p>'</script>b", "ab"),
        ("<b style='visibility:hidden'>n<i style='visibility:visible'>y</i></b>", "y"),
        ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
        ("a &amp; b &lt;c&gt; <3", "a & b <c> <3"),
        ("<head><title>t</title></head><h1>H</h1>x<!-- c -->y", "H\n\nxy"),
        ("<" * 10 + "a href='x", "<" * 10 + "a href='x"),
        (None, ""),
        ("", ""),
        ("a<svg><title>no</title><defs><text>no</text></defs><circle r=1 /><g>no<text>shown</text></g></svg>b", "a\nshown\nb"),
        ("<svg><foreignObject><p>in</p></foreignObject></svg><svg><path/><p>after", "in\n\nafter"),
        ("so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> holds", "so x=2 holds"),
        ("<math/>a<xmp>a<b &amp;\n  <i>c</i></xmp>d", "a\n\na<b &amp;\n  <i>c</i>\n\nd"),
        ("<table><tfoot><tr><td>sum<td>3<tbody><tr><td>x<td>3<thead><tr><td>n<td>v</table>", "n    v\nx    3\nsum  3"),
        ("<details>no<summary>S</summary>no<summary>no</summary></details>x<details open><summary>T</summary>body</details>", "S\nx\nT\nbody"),
        ("<details><p>no</p></details>x", "x"),
    ],
)
def test_html(page, text):
    assert html.extract(page) == text


def test_html_query(spark, small_dir):
    rows = {r.page_id: r for r in result("op3_html_text", spark, small_dir)}
    pages = spark.read.parquet(f"{small_dir}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for page in pages:
        body = re.sub(r"<(script|style|title)\b.*?</\1>|<!--.*?-->", "", page.html, flags=re.S)
        seen = "".join(__import__("html").unescape(re.sub(r"<[^>]*>", " ", body)).split())
        got = "".join(rows[page.page_id].text.split())
        assert got.replace("-", "") == seen.replace("-", "")  # list marks are the renderer's


def plain_table(cells):
    """Columns as wide as their widest cell, two spaces apart."""
    widths = [max(len(row[i]) for row in cells) for i in range(len(cells[0]))]
    lines = ["  ".join(c.ljust(w) for c, w in zip(row, widths)).rstrip() for row in cells]
    return "\n".join(line for row, line in zip(cells, lines) if any(row))


def test_html_tables_by_plain_layout():
    rng = random.Random(3)
    for _ in range(200):
        width, height = rng.randint(1, 5), rng.randint(1, 6)
        cells = [["".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(width)] for _ in range(height)]
        rows = ["<tr>" + "".join(f"<td>{c}" + rng.choice(["", "</td>"]) for c in row) + rng.choice(["", "</tr>"]) for row in cells]
        foot = rng.choice([0, 1]) if height > 1 else 0
        body = "<tbody>" + "".join(rows[: height - foot])
        tail = "<tfoot>" + rows[-1] if foot else ""
        assert html.extract(f"<table>{tail}{body}</table>" if rng.random() < 0.5 else f"<table>{body}{tail}</table>") == plain_table(cells)


def test_html_odd(spark):
    schema = "page_id long, url string, html string, text string"
    odd = spark.createDataFrame([(None, None, None, "t"), (1, "u", "<div>" * 5000 + "deep", "t"), (1, "u", "", "t")], schema)
    assert sorted(r.text for r in html.rendered(spark, odd).collect()) == ["", "", "deep"]
    assert html.rendered(spark, spark.createDataFrame([], schema)).collect() == []


def test_language(spark, small_dir):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = result("op4_language", spark, folder)
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd(spark, odd, empty):
    rows = langid.predictions(spark, odd).collect()
    assert len(rows) == len(ODD)
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (3, 4, 7))
    assert langid.predictions(spark, empty).collect() == []
    unlabelled = langid.predictions(spark, odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_language_sample_keeps_a_rare_language(spark, monkeypatch):
    """Five languages and one a thousandth as frequent: all rows of the rare one are learned from, of the others as many each."""
    learned = []
    real = langid.follow_leader
    monkeypatch.setattr(langid, "follow_leader", lambda rows, *a: learned.extend(r[2] for r in rows) or real(rows, *a))
    monkeypatch.setattr(langid, "temperature_of", lambda scores, labels: learned.extend(labels.tolist()) or 1.0)
    common = 9000
    lang = F.when(F.col("id") >= 5 * common, "rare").otherwise(F.concat(F.lit("l"), F.col("id") % 5))
    docs = spark.range(5 * common + 9).select(F.col("id").alias("doc_id"), lang.alias("lang"), F.concat(F.lit("a "), lang).alias("text"))
    model = langid.train(docs, 300)
    kept = {name: learned.count(i) for i, name in enumerate(model.languages)}
    rare = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(5 * common, 5 * common + 9))
    assert sum(kept.values()) == 300 and kept["rare"] == rare > 0
    assert all(40 <= n <= 80 for name, n in kept.items() if name != "rare")


def test_near_duplicates(spark, small_dir, texts):
    rows = result("op5_near_duplicates", spark, small_dir)
    wanted = plain.near_components(texts)
    assert {r.doc_id: r.component_id for r in rows} == wanted
    assert all(r.n_shingles == len(plain.shingle_set(texts[r.doc_id])) for r in rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    """Small leaves send one group through pivots, deeper levels and the rest of large nodes."""
    monkeypatch.setattr(neardup, "LEAF", 4)
    monkeypatch.setattr(neardup, "PIVOTS", 2)
    base = [f"t{i}" for i in range(120)]
    texts = {}
    for i in range(60):
        words = list(base)
        words[(7 * i) % 120] = f"x{i}"
        if i % 3 == 0:
            words[(11 * i + 50) % 120] = f"y{i}"
        texts[i] = " ".join(words)
    texts |= {100 + i: " ".join(base[: 60 + i]) for i in range(0, 60, 7)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.digests(spark, df).collect()}
    assert got == plain.near_components(texts)


def test_near_duplicates_odd(spark, odd, empty):
    rows = neardup.digests(spark, odd).collect()
    assert len(rows) == len(ODD)
    ids = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert ids[2].component_id == 1 and not ids[2].kept and ids[1].kept
    assert [ids[i].component_id for i in (8, 9, 10)] == [8, 8, 8]
    assert all(ids[i].n_shingles == 0 and ids[i].component_id == i and ids[i].kept for i in (3, 4, 7))
    assert neardup.digests(spark, empty).collect() == []


def test_exact_duplicates(spark, small_dir, texts):
    rows = result("op6_exact_duplicates", spark, small_dir)
    groups = plain.exact_groups(list(texts.items()))
    assert len(rows) == len(texts)
    for row in rows:
        body = plain.SPACE.sub("", texts[row.doc_id] or "")
        assert (row.keep_id, row.group_size) == groups[body]
        assert row.kept == (row.doc_id == row.keep_id) and row.text_sha256 == plain.sha(body.encode())


@pytest.mark.parametrize("copies", [1, 400])
def test_exact_duplicates_odd(spark, odd, empty, copies):
    """With many copies a group runs through several partitions."""
    more = odd.limit(0).unionByName(odd)
    if copies > 1:
        extra = spark.range(copies).select((F.col("id") + 1000).alias("doc_id"), F.lit("hello there").alias("text"))
        more = more.select("doc_id", "text").union(extra)
    rows = exactdup.digests(spark, more).collect()
    data = [(r[0], r[1]) for r in ODD] + ([(1000 + i, "hello there") for i in range(copies)] if copies > 1 else [])
    groups = plain.exact_groups(data)
    assert len(rows) == len(data)
    by_digest = {plain.sha(body.encode()): found for body, found in groups.items()}
    for digest, (keep, size) in by_digest.items():
        own = [r for r in rows if r.text_sha256 == digest]
        assert len(own) == size and {(r.keep_id, r.group_size) for r in own} == {(keep, size)}
        assert [r.doc_id for r in own if r.kept] == [keep]
    assert exactdup.digests(spark, empty).collect() == []


def check_shards(rows, size):
    assert len(rows) == size
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.law == "key" and r.grown_shard in (r.shard, 8) for r in rows)


def test_shards(spark, small_dir, texts):
    rows = result("op7_shards", spark, small_dir)
    check_shards(rows, len(texts))
    assert all(r.size == len((texts[r.doc_id] or "").encode()) + 1 for r in rows)
    assert all(r.text_crc32 == plain.crc(texts[r.doc_id]) for r in rows)
    again = {r.doc_id: (r.shard, r.slot) for r in result("op7_shards", spark, small_dir)}
    assert again == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_shards_odd(spark, odd, empty):
    check_shards(sharding.digests(spark, odd).collect(), len(ODD))
    assert sharding.digests(spark, empty).collect() == []


def test_shard_weights(spark):
    keys = spark.range(20_000).select(sharding.shard_of(F.col("id"), [1, 2, 5]).alias("s"))
    counts = {r.s: r["count"] / 20_000 for r in keys.groupBy("s").count().collect()}
    assert counts == pytest.approx({0: 0.125, 1: 0.25, 2: 0.625}, abs=0.02)


def test_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.predictions(spark, docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    assert sum(p == t for p, t in held) >= 0.93 * len(held)
    assert sum(p for p, t in held if t == 0) <= 0.02 * len(held)


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 1, 1), (2, 1, 0), (8, 1, 0), (9, None, 0), (None, 1, 1), (10, 0, None), (1, 0, 0)], "doc_id long, quality int, toxic int"
    )
    rows = toxicity.predictions(spark, odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.predictions(spark, empty, labels).collect() == []
    assert all(r.predicted == 0 for r in toxicity.predictions(spark, odd, labels.limit(0)).collect())


def check_fingerprints(rows, texts):
    ids = sorted(texts, reverse=True)
    for i, doc_id in enumerate(ids):
        text, following = texts[doc_id] or "", texts[ids[(i + 1) % len(ids)]] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        row = rows[doc_id]
        assert row.n_chars == len(text) and row.edited_sha256 == plain.sha(changed.encode())
        common = 0
        while common < min(len(text), len(changed)) and text[common] == changed[common]:
            common += 1
        assert row.common_edited == common
        assert fingerprints.Prefixes(text).fingerprint() == row.fingerprint


def test_fingerprints(spark, small_dir, texts):
    rows = {r.doc_id: r for r in result("op9_fingerprints", spark, small_dir)}
    assert len(rows) == len(texts)
    check_fingerprints(rows, texts)
    long = [r for r in rows.values() if r.n_chars > 100]
    assert all(0.4 < r.near_edited < 0.8 for r in long)


def test_fingerprints_odd(spark, odd, empty):
    one_each = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in fingerprints.digests(spark, one_each).collect()}
    check_fingerprints(rows, {r[0]: r[1] for r in ODD if r[0] is not None})
    assert fingerprints.digests(spark, odd).count() == len(ODD)
    assert fingerprints.digests(spark, empty).collect() == []
    single = fingerprints.digests(spark, one_each.filter("doc_id = 8")).collect()[0]
    assert single.near_next == 1.0


def test_fingerprints_of_shifted_and_scattered_copies():
    def prose(seed, count):
        pick = random.Random(seed)
        return " ".join("".join(pick.choices("abcdefghij", k=pick.randint(2, 9))) for _ in range(count))

    def like(one, two):
        return fingerprints.likeness(*(fingerprints.Prefixes(t).fingerprint() for t in (one, two)))

    for count in (100, 2000, 20_000):
        text = prose(count, count)
        assert like(text, "inserted " + text) > 0.9 and like("inserted " + text, text) > 0.9
        assert like(text, text[1:]) > 0.9
        assert like(text, prose(count + 1, count)) < 0.05
        assert 0.2 < like(text, prose(7, 3 * count) + text) < 0.3 if count > 2000 else True
    chars = list(text)
    for i in range(20, len(chars), len(chars) // 40):
        chars[i] = "X"
    assert like(text, "".join(chars)) > 0.9
    assert like("word " * 40_000, "x" + "word " * 40_000) > 0.1
    assert like("short", "short text") < 1 and like("a" * 300, "b" * 300) == 0


def test_prefix_hashes_answer_spans():
    one, two = fingerprints.Prefixes("abcabcabd é漢"), fingerprints.Prefixes("xxabcabd é漢y")
    assert one.same(3, two, 2, 9) and not one.same(0, two, 2, 6)
    assert one.extension(3, two, 2) == 9 and one.extension(0, two, 2) == 5
    assert fingerprints.likeness("0:1:", "0:1:") == 1 and fingerprints.likeness("0:1:", one.fingerprint()) == 0


def test_mixing_odd(spark, odd, empty):
    rows = mixing.digests(spark, odd).collect()
    assert len(rows) == len(ODD)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    sizes = [len([w for w in plain.SPACE.split(r[1] or "") if w]) for r in ODD]
    assert sorted(r.size for r in rows) == sorted(sizes)
    targets = {(r.source_size, r.target) for r in rows}
    assert sum(t for _, t in targets) == pytest.approx(sum(sizes))
    assert all(t <= 3 * s + 1e-6 for s, t in targets)
    assert mixing.digests(spark, empty).collect() == []


def test_mixing_repeats_and_cuts(spark):
    rows = [(i, " ".join(["w"] * 10), "en", "a" if i < 8 else "b", 19) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("row_id", F.monotonically_increasing_id())
    taken = mixing.mixed(docs, carry=["row_id"])
    out = mixing.repeated(docs, taken).collect()
    words = {s: sum(len(r.text.split()) for r in out if r.source == s) for s in "ab"}
    goal = {s: t for s, t in {("a" if r.doc_id < 8 else "b", r.target) for r in taken.collect()}}
    assert words == {s: int(t) for s, t in goal.items()}
    assert all(r.n_chars == len(r.text) for r in out)
