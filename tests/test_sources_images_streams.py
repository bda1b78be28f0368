"""Files, images and streams."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogflow.operators import dom, images, pages
from catalogflow.sources import documents, records
from catalogflow.streaming import keyed, streams


def test_ndjson_rules(spark, tmp_path):
    path = str(tmp_path / "a.ndjson")
    with open(path, "w") as f:
        f.write('{"id": "1", "a": NaN, "b": "NaN"}\n\n{"id": "2", "a": 2.5}\n')
    rows = records.read_records(spark, path, "id string, a double, b string", fix_nan=True).orderBy("id").collect()
    assert [(r["id"], r["a"], r["b"]) for r in rows] == [("1", None, "NaN"), ("2", 2.5, None)]
    with open(path, "a") as f:
        f.write("{broken\n")
    with pytest.raises(ValueError, match="line 4"):
        records.read_records(spark, path, "id string, a double", fix_nan=True)
    assert records.read_records(spark, path, "id string", fix_nan=True, strict=False).count() == 2


def test_json_array_rules(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"id": "1"}, {"id": "2"}]')
    assert records.read_records(spark, str(path), "id string", ndjson=False).count() == 2
    path.write_text('{"id": "1"}')
    with pytest.raises(ValueError, match="JSON array"):
        records.read_records(spark, str(path), "id string", ndjson=False)


def test_batches_round_trip(spark, tmp_path):
    df = spark.range(120).withColumnRenamed("id", "k")
    records.write_batches(df, str(tmp_path / "b"), 50, ["k"])
    back = records.read_batches(spark, str(tmp_path / "b"), "k bigint").orderBy("file", "pos").collect()
    assert [r["k"] for r in back] == list(range(120))
    records.write_array_batches(df, str(tmp_path / "c"), 50, ["k"])
    docs = spark.read.text(str(tmp_path / "c")).orderBy("batch").collect()
    assert [k["k"] for d in docs for k in json.loads(d["value"])] == list(range(120))


def test_versions_replace_a_table_in_use(spark, tmp_path):
    path = str(tmp_path / "t")
    assert records.read_version(spark, path) is None
    records.write_version(spark.range(3), path)
    records.write_version(records.read_version(spark, path).filter("id > 0"), path)
    assert records.read_version(spark, path).count() == 2


def test_sku_registry_persists(spark, tmp_path):
    path = str(tmp_path / "skus")
    first = records.commit_skus(spark.range(3), path, ["id"], 50000)
    second = records.commit_skus(spark.range(2), path, ["id"], 50000)
    numbers = lambda df: [r["sku"] for r in df.orderBy("id").collect()]
    assert numbers(first) == ["50000", "50001", "50002"] and numbers(second) == ["50003", "50004"]
    stored = records.read_version(spark, path)
    assert stored.filter("sku IS NOT NULL").count() == 5
    assert stored.agg({"next_auto_sku": "max"}).first()[0] == 50005
    records.write_version(stored.filter("sku IS NULL"), path)  # the promised number outlives the rows
    assert numbers(records.commit_skus(spark.range(1), path, ["id"], 50000)) == ["50005"]


def test_split_folders_keep_keys_apart(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a b"), (2, "a-b"), (3, "a b")], "id int, k string")
    records.write_split(records.split_by_key(rows, "k", ["id"], mode="exact"), str(tmp_path / "s"), ["id"])
    got = spark.read.json(str(tmp_path / "s"))
    assert got.select("folder").distinct().count() == got.select("bucket").distinct().count() == 2


def test_scalar_document_fails(spark):
    with pytest.raises(Exception, match="scalar document"):
        records.normalize_input(spark.createDataFrame([("5",)], "t string"), "t").collect()


def test_catalog_forms(spark, tmp_path):
    (tmp_path / "a.json").write_text('{" 1 ": " /a ", "2": "", "3": "/c"}')
    (tmp_path / "b.json").write_text('[{"upc": "3", "url": "/later"}, {"upc": "", "url": "/x"}]')
    got = {(r["upc"], r["url"]) for r in records.read_catalog(spark, str(tmp_path / "*.json")).collect()}
    assert got == {("1", "/a"), ("3", "/later")}


def test_flatten_wide(spark):
    df = spark.createDataFrame([("7", True, [1, 2], (5,)), ("8", False, [3], None)], "id string, ok boolean, tags array<int>, o struct<x:int>")
    out = records.flatten_wide(df, "id")
    assert out.columns == ["id", "ok", "o", "tags_0", "tags_1"]
    assert [r[:] for r in out.orderBy("id").collect()] == [(7, 1, '{"x":5}', 1, 2), (8, 0, None, 3, None)]


def png(path, pixels):
    h, w = pixels.shape
    raw = b"".join(b"\0" + bytes(np.repeat(row[:, None], 3, axis=1).astype(np.uint8).tobytes()) for row in pixels)

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    path.write_bytes(
        b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    )


def test_image_quality(spark, tmp_path):
    sharp = np.zeros((100, 100))
    sharp[::10, :] = 255
    sharp[:, ::10] = 255
    noise = np.random.default_rng(3).integers(0, 250, (60, 80))
    png(tmp_path / "sharp.png", sharp)
    png(tmp_path / "gray.png", np.full((100, 100), 128))
    png(tmp_path / "noise.png", noise)
    png(tmp_path / "copy.png", noise)
    metrics = images.image_metrics(spark.read.format("image").load(str(tmp_path)))
    got = {r["origin"].rsplit("/", 1)[1]: r for r in metrics.collect()}
    assert got["sharp.png"]["sharpness"] > 100 and got["gray.png"]["sharpness"] < 10
    assert (got["noise.png"]["width"], got["noise.png"]["height"]) == (80, 60)
    p = np.pad(noise, 1, mode="reflect")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * noise
    assert got["noise.png"]["sharpness"] == pytest.approx(lap.var())
    known = metrics.filter(F.col("origin").endswith("copy.png")).select("phash")
    marked = images.mark_placeholders(metrics.withColumn("url", F.col("origin")).withColumn("ord", F.lit(1)).withColumn("k", F.lit(1)), known, "origin")
    hits = {r["origin"].rsplit("/", 1)[1] for r in marked.filter("is_placeholder").collect()}
    assert {"copy.png", "noise.png"} <= hits and "sharp.png" not in hits
    assert images.best_image(marked, ["k"], "ord").first()["url"].endswith("sharp.png")


def test_hash_bands_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**63), 2**63, 40, dtype=np.int64)
    rows = []
    for i, b in enumerate(base):
        flips = rng.choice(64, size=i % 16, replace=False)
        value = int(np.uint64(b) ^ np.uint64(sum(1 << int(f) for f in flips)))
        rows.append((i, value - 2**64 if value >= 2**63 else value))
    df = spark.createDataFrame(rows, "k long, phash long")
    known = spark.createDataFrame([(int(b),) for b in base], "phash long")
    distance = lambda a, b: bin((a ^ int(b)) & (2**64 - 1)).count("1")
    for limit in (10, 20):
        want = {k for k, v in rows if any(distance(v, b) <= limit for b in base)}
        for block in (1000, 8):  # all known hashes at once; the index, and for 20 bits blocks
            assert {r["k"] for r in images.placeholder_join(df, known, "k", limit=limit, block=block).collect()} == want
    ready = known.withColumnRenamed("phash", "__known")
    met = images.indexed_pairs(df, ready, "k", "phash", 10)
    assert met.filter("NOT bit_count(__own ^ __known) <= 10").count() < 0.1 * len(rows) * len(base)


def test_dom_positions(spark):
    html = '<div id="a">x\n<p>é<b>1</b></p><img src="i"><ul><li>one<li>two</ul></div><P CLASS="z">end'
    nodes = dom.dom_nodes(spark.createDataFrame([(1, html)], "page int, html string"), "page")
    got = {r["node"]: (r["tag"], r["inner"], r["ancestors"]) for r in nodes.collect()}
    assert got[1] == ("p", "é<b>1</b>", [0]) and got[2] == ("b", "1", [0, 1])
    assert got[3][0] == "img" and got[4][0] == "ul"
    assert got[7] == ("p", "end", [])


def test_page_details(value):
    assert value(pages.nutrition_text(F.lit("Protein 3%"), F.lit("300 kcal"))) == "Protein 3%\nCaloric Content: 300 kcal"
    assert value(pages.nutrition_text(F.lit(""), F.lit(""))) == ""
    assert value(pages.spaced_list(F.lit("a,b, c"))) == "a, b, c"
    assert value(pages.size_info(F.lit(" 5 lb,  10 lb. "))) == "5 lb, 10 lb"
    html = '<i data-media="a:G1; b:G2 ;G3"></i><i data-media="c:G1"></i>'
    assert value(pages.media_addresses(F.lit(html), F.lit("https://c/"), "_m")) == ["https://c/G1_m", "https://c/G2_m", "https://c/G3_m"]


def test_title_rules(value):
    twice = "Golden Meadow Oil Supplement" * 2
    assert value(pages.halved(F.lit(twice))) == "Golden Meadow Oil Supplement"
    assert value(pages.halved(F.lit("abab"))) == "abab"
    assert value(pages.brand_of_title(F.lit("Maker® Feed"), "X")) == "Maker"


def test_streams_over_several_files(spark, tmp_path):
    source = tmp_path / "in"
    outcomes = ["FFF", "FF", "SFF"]
    n = 0
    for i, part in enumerate(outcomes):
        rows = [("a", n + j, c == "F") for j, c in enumerate(part)] + [("b", n + j, False) for j in range(len(part))]
        n += len(part)
        spark.createDataFrame(rows, "s string, o long, f boolean").coalesce(1).write.mode("append").parquet(str(source))
        # every drain takes the new file only and goes on from the stored state
        stream = streams.file_stream(spark, str(source), "s string, o long, f boolean", files_per_trigger=1)
        streams.breaker_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "ck"), "s", ["o"], F.col("f"), 5)
        store = keyed.KeyedState(spark, str(tmp_path / "state"), "s string, carried bigint, tripped boolean", ["s"])
        assert all(len(v) <= 2 for v in store.versions().values())  # what a batch read and what it wrote
    got = spark.read.parquet(str(tmp_path / "out")).filter("s = 'a'").orderBy("o").collect()
    assert [r["failures"] for r in got] == [1, 2, 3, 4, 5, 0, 1, 2]
    assert [r["disabled"] for r in got] == [False] * 5 + [True] * 3


def test_upsert_stream_modes(spark, tmp_path):
    source = tmp_path / "in"
    for i in range(2):
        spark.createDataFrame([("a", i), ("b", 10 + i)] if i == 0 else [("a", i), ("c", 10 + i)], "k string, o long").coalesce(1).write.mode("append").parquet(str(source))
        for mode in ("skip", "overwrite"):
            stream = streams.file_stream(spark, str(source), "k string, o long")
            streams.upsert_stream(stream, str(tmp_path / mode), str(tmp_path / f"ck{mode}"), ["k"], ["o"], mode)
    rows = lambda mode: sorted((r["k"], r["o"]) for r in streams.read_upserted(spark, str(tmp_path / mode), ["k"]).collect())
    assert rows("skip") == [("a", 0), ("b", 10), ("c", 11)]
    assert rows("overwrite") == [("a", 1), ("b", 10), ("c", 11)]


def test_state_rewrites_touched_buckets_only(spark, tmp_path):
    store = keyed.KeyedState(spark, str(tmp_path), "k bigint, v bigint", ["k"], buckets=8)
    rows = lambda keys, v: spark.createDataFrame([(k, v) for k in keys], "k bigint, v bigint")
    store.write(rows(range(40), 0), 0)
    one = keyed.touched(rows([3], 1).select(keyed.bucket_of(["k"], 8).alias(keyed.BUCKET)))
    mates = sorted(r.k for r in store.read(1, one).collect())
    assert 3 in mates and 0 < len(mates) < 20
    store.write(rows(mates, 1), 1)
    assert {b: v for b, v in store.versions().items() if b in one} == {one[0]: [0, 1]}
    assert all(v == [0] for b, v in store.versions().items() if b not in one)
    assert {r.k: r.v for r in store.read(2).collect()} == {k: int(k in mates) for k in range(40)}
    assert {r.v for r in store.read(1).collect()} == {0}  # a replayed batch reads what it read before
    store.write(rows(mates, 2), 2)
    store.compact(2)
    assert store.versions()[one[0]] == [1, 2] and {r.k for r in store.read(2).collect()} == set(range(40))


def test_skip_stream_reads_only_files_that_may_hold_a_key(spark, tmp_path):
    source, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    reports = []
    for batch in ([(k, 0) for k in range(200)], [(k, 1) for k in range(1000, 1200)], [(7, 2), (5000, 2)], [(7, 3)]):
        spark.createDataFrame(batch, "k long, o long").coalesce(1).write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source, "k long, o long")
        reports += streams.upsert_stream(stream, out, ck, ["k"], ["o"], "skip", buckets=16)
    got = {r.k: r.o for r in streams.read_upserted(spark, out, ["k"]).collect()}
    assert got == {k: 0 for k in range(200)} | {k: 1 for k in range(1000, 1200)} | {5000: 2}
    assert [r["files"] for r in reports] == [0, 16, 32, 33]
    assert reports[1]["read"] == 0 and 1 <= reports[2]["read"] <= 2 and reports[3]["read"] == 1


def test_key_filters_let_no_key_through_unseen(spark, tmp_path):
    filters = keyed.KeyFilters(spark, str(tmp_path), ["k"], buckets=4, words=64)
    keys = lambda a, b: spark.range(a, b).withColumnRenamed("id", "k")
    filters.write(keys(0, 1500), 0)
    for a in (0, 700, 1499):
        bucket = keyed.touched(keys(a, a + 1).select(keyed.bucket_of(["k"], 4).alias(keyed.BUCKET)))[0]
        assert (0, bucket) in filters.may_hold(keys(a, a + 1), 1)
    assert filters.may_hold(keys(0, 5), 0) == set()  # nothing before the first batch


def test_one_json_document_is_read_by_many_tasks(spark, tmp_path):
    """Strings with brackets, commas and escapes, nested values and line ends, with range borders everywhere."""
    rng = np.random.default_rng(7)
    odd = ['a,b', '},{', '\\', '"', '\\"', '],[', 'é,ü', '{"x": "[,"}', '\n', ' , ', "ends with \\", '\\\\",']
    rows = [{"id": k, "s": "".join(rng.choice(odd, rng.integers(0, 6))), "deep": [{"n": [1, 2, {"m": ","}]}, []]} for k in range(120)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=1, ensure_ascii=False))
    (tmp_path / "b.json").write_text(" \n" + json.dumps(rows[:7]) + "\n\n")
    (tmp_path / "c.json").write_text(" [ \n ] ")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for size in ("97", "4096", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            if size == "97":
                assert spark.read.option("lineSep", ",").text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 50
            found = documents.elements(spark, str(tmp_path / "*.json")).collect()
            back = records.read_records(spark, str(tmp_path / "*.json"), "id bigint, s string", ndjson=False).collect()
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        whole = {name: [json.loads(r.element) for r in sorted(found, key=lambda r: r.idx) if r.file.endswith(name)] for name in ("a.json", "b.json", "c.json")}
        assert whole == {"a.json": rows, "b.json": rows[:7], "c.json": []}
        assert sorted((r.id, r.s) for r in back) == sorted((r["id"], r["s"]) for r in rows + rows[:7])


def test_documents_that_are_no_arrays_of_objects(spark, tmp_path):
    for name, text in {"open": '[{"a": 1}', "string": '[{"a": "x}]', "object": '{"a": 1}', "scalar": "7", "mixed": '[{"a": 1}, 2]', "empty": ""}.items():
        (tmp_path / f"{name}.json").write_text(text)
    for name in ("open", "string", "object", "scalar", "mixed", "empty"):
        if name != "empty":  # an empty file has no piece that could tell
            with pytest.raises(ValueError, match=name):
                records.read_records(spark, str(tmp_path / f"{name}.json"), "a bigint", ndjson=False)
    kept = records.read_records(spark, str(tmp_path / "*.json"), "a bigint", ndjson=False, strict=False)
    assert [r.a for r in kept.collect()] == [1]


def test_elements_of_a_document_are_put_together_once(spark, tmp_path):
    """What reads the elements, the check for odd ones too, finds them written and does not join the pieces again."""
    (tmp_path / "a.json").write_text(json.dumps([{"id": k, "s": "x, y"} for k in range(50)]))
    back = records.read_records(spark, str(tmp_path / "a.json"), "id bigint, s string", ndjson=False)
    assert "Join" not in back._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.id for r in back.collect()) == list(range(50))


def test_unreadable_documents_fail_and_null_ones_hold_nothing(spark):
    docs = lambda *texts: records.normalize_input(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, doc string"), "doc")
    assert docs(None, '{"a": 1}').select("k", "record").collect() == [(1, '{"a":1}')]
    for bad in ("{bad json", "7"):
        with pytest.raises(Exception, match="unreadable"):
            docs(bad).collect()


def test_perceptual_hash_does_not_depend_on_the_order_of_sums():
    from catalogflow.operators.images import _perceptual_hash

    half = [
        [144, 136, 139, 192], [155, 89, 226, 149], [236, 96, 62, 135], [92, 132, 236, 43],
        [69, 110, 34, 125], [64, 111, 50, 33], [136, 202, 192, 133], [125, 184, 217, 189],
    ]
    mirrored = np.array([row + row[::-1] for row in half])
    bits = [[_perceptual_hash(mirrored) >> (63 - 8 * y - x) & 1 for x in range(8)] for y in range(8)]
    assert len({bits[y][x] for y in range(8) for x in (1, 3, 5, 7)}) == 1  # these frequencies are zero in a mirrored image
