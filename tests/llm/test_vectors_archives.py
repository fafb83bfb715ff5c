"""Nearest neighbours against brute force, and WARC archives against plain reads."""

import gzip
import os

import pytest

pytest.importorskip("weft.llm")

import numpy as np  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from weft.llm import ann  # noqa: E402
from weft.llm.ann import nearest_neighbours, scan_list  # noqa: E402
from weft.llm.common import kept  # noqa: E402
from weft.llm.queries import op6_neighbours  # noqa: E402
from weft.llm.warc import _ranges, parse_record, payload_digest, read_warc, record, write_warc  # noqa: E402
from weft.sources.scratch import scratch_path  # noqa: E402


def brute(ids, vectors, query_ids, k):
    lengths, answer = np.linalg.norm(vectors, axis=1), {}
    for q in query_ids:
        at = int(np.flatnonzero(ids == q)[0])
        score = (vectors * vectors[at]).sum(axis=1) / (lengths * lengths[at])
        score[ids == q] = -np.inf
        order = [i for i in np.lexsort((ids, -score))[:k] if ids[i] != q]
        answer[q] = [(int(ids[i]), float(score[i])) for i in order]
    return answer


def test_recall_on_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], float)
    want = brute(ids, vectors, ids[ids % 50 == 0].tolist(), 5)
    found = {}
    for r in op6_neighbours(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(found) == set(want) and all(len(f) == 5 for f in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    exact = {q: dict(zip(ids.tolist(), (vectors * vectors[ids == q]).sum(axis=1))) for q in want}
    length = dict(zip(ids.tolist(), np.linalg.norm(vectors, axis=1)))
    for q, pairs in found.items():
        assert [i for i, _ in pairs] == [i for i, _ in sorted(pairs, key=lambda p: (-p[1], p[0]))]
        assert all(s == pytest.approx(exact[q][i] / length[q] / length[i], abs=1e-12) for i, s in pairs)


def test_scan_of_a_list_gives_up_nothing_near():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 32))
    vectors = centres[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 32))
    ids = rng.permutation(10_000)[:3000]
    turn = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    rotated = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True) @ turn
    asked = ids[:200]
    want, found = brute(ids, vectors, asked.tolist(), 5), {}
    for q, i, s in scan_list(vectors[:200], asked, vectors, ids, rotated, 5):
        for a, b in zip(q.tolist(), i.tolist()):
            found.setdefault(a, []).append(b)
    hits = sum(len(set(found[q]) & {i for i, _ in want[q]}) for q in want)
    assert hits / 1000 > 0.97


def test_cells_ties_and_hot_vectors(spark, monkeypatch):
    """Tiny pieces and blocks, a third of all rows one vector, and one list probed by all."""
    monkeypatch.setattr(ann, "PIECE", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(300, 8)).astype(np.float32)
    vectors[::3] = vectors[0]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    rows = rows.withColumns({"_list": F.lit(1), "rank": F.lit(2), "SCORE": F.lit(3)})
    found = {}
    for r in nearest_neighbours(rows, F.col("vec_id") % 5 == 0, probes=10_000).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    want = brute(np.arange(300), vectors.astype(float), list(range(0, 300, 5)), 5)
    for q, pairs in want.items():
        assert [found[q][k] for k in range(1, 6)] == [i for i, _ in pairs]


def test_neighbours_of_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0])]
    rows += [(6, [inf, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (9, [1.0, 1.0]), (9, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest_neighbours(df, F.col("vec_id") >= 0).orderBy("query_id", "rank").collect()
    pairs = [(r["query_id"], r["rank"], r["vec_id"]) for r in found]
    assert pairs == [(0, 1, 1), (0, 2, 9), (0, 3, 9), (1, 1, 9), (1, 2, 9), (1, 3, 0), (9, 1, 1), (9, 2, 0)]
    assert found[0]["score"] == pytest.approx(0.5**0.5)
    assert nearest_neighbours(df.limit(0), F.col("vec_id") >= 0).count() == 0
    assert nearest_neighbours(df.filter("vec_id = 0"), F.col("vec_id") >= 0).count() == 0


def test_each_dimension_has_its_own_neighbours(spark):
    """Also where one has a row more than another; an id in both asks with its least vector."""
    rng = np.random.default_rng(2)
    sizes = {3: 41, 5: 40, 8: 1}
    rows, at = [], 0
    for d, n in sizes.items():
        rows += [(at + i, rng.normal(size=d).tolist()) for i in range(n)]
        at += n
    rows.append((0, [9.0] * 5))  # beside the vector of id 0 with three components
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {}
    for r in nearest_neighbours(df, F.col("vec_id") % 2 == 0, probes=10_000).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    for d in sizes:
        same = [(i, v) for i, v in rows if len(v) == d]
        asked = [i for i, v in same if i % 2 == 0 and v == min(w for j, w in rows if j == i)]
        want = brute(np.array([i for i, _ in same]), np.array([v for _, v in same]), asked, 5)
        for q, pairs in want.items():
            assert found.pop(q, []) == [i for i, _ in pairs]
    assert not found


def test_a_row_repeated_often_is_many_pieces(spark, monkeypatch):
    """All rows have one id but for two, so a piece by id would hold a whole list."""
    monkeypatch.setattr(ann, "PIECE", 16)
    written = {}
    monkeypatch.setattr(ann, "kept", lambda df, label: written.setdefault(label, kept(df, label)))
    rows = [(7, [1.0, 2.0])] * 200 + [(8, [1.0, 2.1]), (50, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    found = nearest_neighbours(df, F.col("vec_id") % 50 == 0, probes=10_000).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [7, 7, 7, 7, 7]
    turns = written["ann-index"].groupBy(F.pmod("_turn", F.lit(202 // 16 + 1))).count()
    assert turns.agg(F.max("count")).first()[0] <= 16


PAGES = [
    (3, "http://a/3", "<p>same</p>"),
    (1, "http://a/1", "<p>same</p>"),
    (1, "http://a/1", "<p>same</p>"),
    (None, None, "<p>same</p>"),
    (5, "http://b/\r\nX: y", None),
    (6, "http://b/é", ""),
    (7, "", "line\r\n\r\nWARC/1.1\r\n\r\nmore é 的"),
    (8, "http://c", "long " * 400_000),
]


@pytest.fixture
def pages(spark):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return rows.withColumns({"file": F.lit(1), "_key": F.lit(2), "digest": F.lit(3)}).repartition(3)


def test_records_round_trip():
    data = record("7", "http://x", None, b"body\r\n\r\n", payload_digest(b"body\r\n\r\n"))
    headers, block = parse_record(data)
    assert headers["warc-type"] == "response" and block.endswith(b"\r\n\r\nbody\r\n\r\n")
    with pytest.raises(ValueError):
        parse_record(data[:-1])


def test_archives_of_edge_rows(spark, pages):
    folder = scratch_path(spark, "warc")
    index = write_warc(pages, folder, file_bytes=200)
    back = read_warc(index, folder).collect()
    assert len(back) == len(PAGES)
    key = lambda r: (str(r[0]), r[1] or "")
    bodies = sorted(((p[0], (p[1] or "").replace("\r", "%0D").replace("\n", "%0A"), (p[2] or "").encode()) for p in PAGES), key=key)
    for (id, url, body), r in zip(bodies, sorted(((r["page_id"], r["url"], r) for r in back), key=key)):
        r = r[2]
        assert r["page_id"] == id and (r["url"] or "") == url
        assert r["payload_bytes"] == len(body) and r["payload_digest"] == payload_digest(body)
        assert (r["payload"] is None) == (r["record_type"] == "revisit") == (r["refers_to"] is not None)
        assert r["payload"] is None or bytes(r["payload"]) == body
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in back)
    assert [k for k in kinds if k[1] == "revisit"] == [
        ("1", "revisit", 1), ("3", "revisit", 1), ("6", "revisit", 5), ("None", "revisit", 1)
    ]
    assert sum(r["url"] is None for r in back) == 1


def test_pages_from_one_file_row_share_a_payload(spark, tmp_path):
    spark.createDataFrame([(1, ["same", "same", "other"])], "page_id long, bodies array<string>").write.parquet(f"{tmp_path}/in")
    exploded = spark.read.parquet(f"{tmp_path}/in").select("page_id", F.lit("http://a").alias("url"), F.explode("bodies").alias("html"))
    folder = scratch_path(spark, "warc")
    kinds = sorted(r["record_type"] for r in read_warc(write_warc(exploded, folder, least_revisit=1), folder).collect())
    assert kinds == ["response", "response", "revisit"]


def test_small_payloads_are_all_responses(spark, pages):
    folder = scratch_path(spark, "warc")
    kinds = [r["record_type"] for r in read_warc(write_warc(pages, folder, least_revisit=12), folder).collect()]
    assert kinds == ["response"] * len(PAGES)


def test_selected_records_and_whole_files(spark, pages):
    folder = scratch_path(spark, "warc")
    index = write_warc(pages, folder)
    some = read_warc(index.filter(F.col("url").startswith("http://a") & (F.col("record_type") == "response")), folder)
    assert [r["page_id"] for r in some.collect()] == [1]
    assert read_warc(index.limit(0), folder).count() == 0
    assert write_warc(pages.limit(0), folder + "-none").count() == 0
    # Each archive is a sequence of gzip members, one per record.
    local = folder.removeprefix("file://")
    whole = b"".join(gzip.decompress(open(os.path.join(local, f), "rb").read()) for f in sorted(os.listdir(local)))
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES)


def test_near_ranges_are_read_together():
    import pyarrow as pa

    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 5), ("b", 105, 5), ("b", 110, 90)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["file", "offset", "length"])
    runs = list(_ranges(iter([batch.slice(0, 2), batch.slice(2)]), gap=5, most=80))
    assert [len(r) for r in runs] == [3, 1, 1, 1]
    assert [x for r in runs for x in r] == rows


@pytest.mark.parametrize("copies", [1, 6, 50])
def test_repeated_queries_find_equal_vectors_of_other_ids(spark, copies):
    rng = np.random.default_rng(copies)
    vectors = rng.normal(size=(60, 8))
    vectors[59] = vectors[0]
    vectors[40:45] = vectors[10]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [rows[0]] * (copies - 1) + [rows[41]] * (copies - 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    ids, table = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    want = brute(ids, table, [0, 10, 20, 30, 40, 50], 5)
    found = {}
    for r in nearest_neighbours(df, F.col("vec_id") % 10 == 0, probes=10_000).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert {q: [i for i, _ in pairs] for q, pairs in found.items()} == {q: [i for i, _ in pairs] for q, pairs in want.items()}
    assert found[0][0][0] == 59 and found[0][0][1] == pytest.approx(1)
    # As many lists are probed as hold rows besides the query's own.
    few = nearest_neighbours(df.filter("vec_id IN (0, 59, 20)"), F.col("vec_id") == 0, probes=1).collect()
    assert len({r["vec_id"] for r in few}) == 2


def test_archives_are_read_by_tasks_of_bounded_bytes(spark):
    folder = scratch_path(spark, "warc")
    noise = np.random.default_rng(1)
    pages = [(i, f"http://x/{i}", noise.bytes(40_000).hex()) for i in range(120)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    index = write_warc(df.repartition(4), folder)
    total = index.agg(F.sum("length")).first()[0]
    for size in (200_000, 1 << 30):
        read = read_warc(index, folder, task_bytes=size, payloads=False)
        tasks = read.select(F.spark_partition_id().alias("p"), "page_id").groupBy("p").count().collect()
        wanted = max(-(-total // size), min(8, total // (1 << 20)))
        assert wanted * 0.6 <= len(tasks) <= wanted and sum(r["count"] for r in tasks) == 120
