"""Exact and near duplicates against brute force and SQL."""

import hashlib
import re
import signal
from itertools import combinations

import duckdb
import pytest

pytest.importorskip("weft.llm")

import numpy as np  # noqa: E402
import xxhash  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from weft.llm import exact, simhash  # noqa: E402
from weft.llm.exact import drop_exact_copies, exact_groups, update_state  # noqa: E402
from weft.llm.queries import ORACLES, QUERIES  # noqa: E402
from weft.llm.simhash import (  # noqa: E402
    choose_vantages,
    dealt_nodes,
    drop_near_copies,
    fingerprint,
    halves,
    join_trees,
    link_nodes,
    near_components,
    near_links,
    shards_of,
)
from weft.sources.scratch import scratch_path  # noqa: E402

SMALL = "/root/testdata/sf0.001"
EDGE = [
    (11, "a  b"),
    (2, "a b"),
    (3, None),
    (3, ""),
    (None, "a\tb"),
    (5, "Same Words Here, and more"),
    (5, "Same Words Here, and more"),
    (6, "same words here, and more"),
    (7, " \n "),
    (8, "very long " * 100_000),
    (9, "a\u00a0b"),  # a no-break space is not white space here
]


@pytest.fixture
def edge(spark):
    rows = spark.createDataFrame(EDGE, "doc_id long, text string").repartition(4)
    return rows.withColumns({"_digest": F.lit(1), "_PLACE": F.lit(2), "fingerprint": F.lit(3), "kept": F.lit(4)})


def space(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("sent", [0, 1000])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_of_edge_rows(edge, monkeypatch, weak, sent):
    """A weak digest puts different texts under one state; their bytes part them."""
    monkeypatch.setattr(exact, "HITS_SENT", sent)
    options = {"digest": lambda text: F.length(text) % 3} if weak else {}
    rows = exact_groups(edge, **options).collect()
    groups = {}
    for id, text in EDGE:
        groups.setdefault(space(text), []).append(id)
    assert len(rows) == len(EDGE)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in rows:
        ids = by_sha[r["text_sha256"]]
        assert r["doc_id"] in ids
        assert r["keep_id"] == min(i for i in ids if i is not None)
        assert r["group_size"] == len(ids)
    assert sum(r["kept"] for r in rows) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


def test_drop_exact_copies(spark, edge):
    rows = drop_exact_copies(edge)
    assert rows.columns == edge.columns
    assert sorted(space(r["text"]) for r in rows.collect()) == sorted({space(t) for _, t in EDGE})
    assert drop_exact_copies(edge.limit(0)).count() == 0
    assert exact_groups(edge.limit(0)).count() == 0


def test_rows_of_one_file_row_and_of_a_shuffle_are_told_apart(spark, tmp_path):
    documents = [(1, ["a", "b"]), (2, ["a", "c"]), (3, ["d", "d"])]
    spark.createDataFrame(documents, "doc_id long, texts array<string>").write.parquet(f"{tmp_path}/in")
    scan = spark.read.parquet(f"{tmp_path}/in")
    passages = scan.select("doc_id", F.explode("texts").alias("text"))
    for frame in (passages, passages.repartition(5, F.rand())):
        rows = sorted((r["doc_id"], r["text"]) for r in drop_exact_copies(frame).collect())
        assert rows == [(1, "a"), (1, "b"), (2, "c"), (3, "d")]
        assert sorted(r["kept"] for r in exact_groups(frame).collect()) == [False] * 2 + [True] * 4
    twice = passages.filter("doc_id = 3")
    assert drop_exact_copies(twice.unionByName(twice)).count() == 1
    both = spark.read.parquet(f"{tmp_path}/in", f"{tmp_path}/in").select("doc_id", F.concat_ws(" ", "texts").alias("text"))
    assert both.count() == 6 and drop_exact_copies(both).count() == 3


def test_state_takes_up_later_arrivals(spark):
    folder, state = scratch_path(spark, "arrivals"), scratch_path(spark, "state")
    first = spark.createDataFrame([(5, "p1", b"x"), (7, "p2", b"y")], "_id long, _place string, _digest binary")
    later = spark.createDataFrame([(3, "p3", b"x"), (9, "p4", b"z")], first.schema)
    first.write.parquet(folder)
    assert update_state(folder, state, first).count() == 2
    later.write.mode("append").parquet(folder)
    rows = {bytes(r["_digest"]): (r["_keep"]["_id"], r["_size"]) for r in update_state(folder, state, first).collect()}
    assert rows == {b"x": (3, 2), b"y": (7, 1), b"z": (9, 1)}


def test_exact_plan_has_no_python(spark):
    from tests.plans import explain

    plan = explain(QUERIES["op7_exact_dedup"](spark, SMALL))
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", ["op7_exact_dedup", "op10_warc"])
def test_queries_with_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    found = QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(columns).collect()), key=repr) == sorted(result.fetchall(), key=repr)


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(values)), 2):
        if (int(values[i]) ^ int(values[j])).bit_count() <= 3:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(len(values))]


def crowd(seed, centres, copies, most):
    rng = np.random.default_rng(seed)
    values = list(rng.integers(0, 1 << 63, centres, dtype=np.uint64))
    for centre in values[: centres // 4]:
        for _ in range(copies):
            x = int(centre)
            for _ in range(rng.integers(1, most + 1)):
                x ^= 1 << int(rng.integers(0, 64))
            values.append(np.uint64(x))
    return np.unique(np.array(values, np.uint64))


def test_fingerprints():
    for _, text in EDGE[:8]:
        assert fingerprint((text or "").encode()) == plain_fingerprint(text)
    text = "Ünï Code Ä words IN a Row\x0b\x0cÉ x y z"
    assert fingerprint(text.encode()) == plain_fingerprint(text)
    assert fingerprint(b"  ") == 0


@pytest.mark.parametrize("values", [crowd(1, 900, 4, 5), crowd(2, 8, 600, 6), crowd(3, 4, 1200, 2)])
def test_links_equal_all_pairs(monkeypatch, values):
    monkeypatch.setattr(simhash, "BLOCK", 32)
    assert link_nodes(values).tolist() == plain_components(values)


def test_links_of_a_crowd_around_its_middle_end():
    """One side of the split is the whole crowd, which must not be split again."""
    near = [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(64) for j in range(i)][:300]
    far = [(0xFFFFFF << 40) ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)][:300]
    others = near + far
    values = np.array(others[:332] + [0] + others[332:], np.uint64)
    assert len(np.unique(values)) == len(values) == 665 and values[len(values) // 2] == 0

    def late(*_):
        raise TimeoutError

    before = signal.signal(signal.SIGALRM, late)
    signal.alarm(30)
    try:
        found = link_nodes(values)
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)
    assert found.tolist() == plain_components(values)


def test_no_link_is_lost_between_shards():
    values = crowd(5, 900, 4, 5)
    shards, names = {}, set()
    for half, metric in enumerate(halves(3)):
        rows, codes = shards_of(values, choose_vantages(values, 4, [metric]), half)
        names |= set(codes.tolist())
        for row, code in zip(rows.tolist(), codes.tolist()):
            shards.setdefault(row, set()).add(code)
    for i, j in combinations(range(len(values)), 2):
        if (int(values[i]) ^ int(values[j])).bit_count() <= 3:
            assert shards[i] & shards[j]
    assert 16 < len(names) <= 32


def test_shards_are_bounded(spark, monkeypatch):
    """Even where a crowd is too dense to be cut by distance."""
    monkeypatch.setattr(simhash, "SHARD_NODES", 60)
    monkeypatch.setattr(simhash, "MOST_NODES", 120)
    dense = np.array([0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(64) for j in range(i)][:300], np.uint64)
    values = np.unique(np.concatenate([crowd(8, 500, 3, 4), dense ^ np.uint64(0x5A5A << 20)]))
    nodes = spark.createDataFrame([(v,) for v in values.view(np.int64).tolist()], "fingerprint long")
    shards = {}
    for r in dealt_nodes(nodes, len(values)).collect():
        shards.setdefault(r["shard"], set()).add(r["fingerprint"] & (1 << 64) - 1)
    assert max(map(len, shards.values())) <= 120
    together = {pair for members in shards.values() for pair in combinations(sorted(members), 2)}
    near = [(a, b) for a, b in combinations(values.tolist(), 2) if (a ^ b).bit_count() <= 3]
    assert len(near) > 10_000 and together.issuperset(near)
    trees = {r["u"]: r["v"] for r in join_trees(near_links(nodes, len(values))).collect()}
    signed = values.view(np.int64)
    groups = {}
    for v in signed.tolist():
        groups.setdefault(trees.get(v, v), set()).add(v)
    want = {}
    for v, root in zip(signed.tolist(), plain_components(values)):
        want.setdefault(root, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_trees_join_to_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 50), (101, 100), (101, 50)]
    found = join_trees(spark.createDataFrame(edges, "u long, v long")).collect()
    want = {i: 0 for i in range(1, 41)} | {100: 50, 101: 50}
    assert {r["u"]: r["v"] for r in found} == want and len(found) == len(want)
    assert join_trees(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("shard", [16_384, 40])
def test_near_components_of_documents(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD_NODES", shard)
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    edge = spark.createDataFrame([(None if i is None else i + 10_000, t) for i, t in EDGE], documents.schema)
    rows = documents.union(edge)
    found = near_components(rows).collect()
    pairs = [(r["doc_id"], r["text"]) for r in rows.collect()]
    assert len(found) == len(pairs)
    prints = {(i, plain_fingerprint(t)) for i, t in pairs}
    values = sorted({p for _, p in prints})
    roots = dict(zip(values, plain_components(values)))
    lowest = {}
    for i, p in prints:
        if i is not None:
            lowest[roots[p]] = min(i, lowest.get(roots[p], i))
    for r in found:
        value = r["fingerprint"] & (1 << 64) - 1
        assert (r["doc_id"], value) in prints
        assert r["component_id"] == lowest[roots[value]]


def test_drop_near_copies(edge):
    rows = drop_near_copies(edge)
    assert rows.columns == edge.columns
    given = edge.collect()
    prints = [plain_fingerprint(r["text"]) for r in given]
    values = sorted(set(prints))
    roots = dict(zip(values, plain_components(values)))
    stays = {}
    for r, p in zip(given, prints):
        stays.setdefault(roots[p], []).append(r["doc_id"])
    least = [min((i for i in ids if i is not None), default=None) for ids in stays.values()]
    assert sorted(str(r["doc_id"]) for r in rows.collect()) == sorted(map(str, least))
    assert drop_near_copies(edge.limit(0)).count() == 0


def test_near_copies_are_dropped_by_row_not_by_id(spark):
    a, b = "a text of some words that is found in many rows", "quite another one, which only one row holds here"
    rows = [(1, a), (2, a), (2, b), (None, a), (None, a), (None, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_place": F.lit(1), "fingerprint": F.lit(2)})
    found = drop_near_copies(df.repartition(3))
    assert found.columns == df.columns
    assert sorted((tuple(r)[:2] for r in found.collect()), key=repr) == [(1, a), (2, b), (7, "")]


def test_registered_query_of_near_copies(spark):
    from weft.llm.queries import op4_simhash

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    values = sorted(set(prints.values()))
    roots, lowest = dict(zip(values, plain_components(values))), {}
    for i, p in prints.items():
        lowest[roots[p]] = min(i, lowest.get(roots[p], i))
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op4_simhash(spark, SMALL).collect()}
    assert found == {i: (f"{p:016x}", lowest[roots[p]]) for i, p in prints.items()}
