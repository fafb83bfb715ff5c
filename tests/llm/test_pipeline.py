"""The pipeline's stages against plain Python over the same models."""

import re
import struct
import zlib

import pytest

pytest.importorskip("weft.llm")

import pyarrow as pa  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402
from tests.llm.test_copies import plain_components, plain_fingerprint, space  # noqa: E402
from tests.llm.test_texts import plain_bases  # noqa: E402
from weft.llm.quality import statistics  # noqa: E402
from weft.llm.queries import trained_quality  # noqa: E402
from weft.llm.secrets import learn_formats, scan_secrets  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_stages_are_the_named_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_copies", "near_copies", "secrets", "packing"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The small tables with a near copy of the longest texts and some secrets."""
    folder = str(tmp_path_factory.mktemp("planted"))
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = documents.collect()
    longest = sorted(rows, key=lambda r: -r["n_chars"])[:5]
    extra = [(10_000 + k, r["text"] + " end", r["lang"], r["source"], r["n_chars"] + 4) for k, r in enumerate(longest)]
    for k, r in enumerate(rows[:8]):
        text = f"{r['text']}\ntoken = {k}abcdef é AKIA{'Q2W3' * 4} {'0f' * 14}"
        extra.append((20_000 + k, text, r["lang"], r["source"], len(text)))
    both = documents.union(spark.createDataFrame(extra, documents.schema)).repartition(3)
    both.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_equals_plain_python(spark, planted):
    documents = spark.read.parquet(f"{planted}/documents.parquet")
    docs = {r["doc_id"]: r for r in documents.collect()}
    model = trained_quality(spark, planted)
    good = {
        i for i, r in docs.items() if model.scores(statistics(pa.array([r["text"]], pa.string())))[0] >= 0.3
    }
    assert 0 < len(good) < len(docs)
    first = {}
    for i in sorted(good):
        first.setdefault(space(docs[i]["text"]), i)
    single = sorted(first.values())
    prints = [plain_fingerprint(docs[i]["text"]) for i in single]
    values = sorted(set(prints))
    root = dict(zip(values, plain_components(values)))
    lowest = {}
    for i, p in zip(single, prints):
        lowest.setdefault(root[p], i)
    left = sorted(lowest.values())
    assert len(left) < len(single) < len(good)
    frame = documents.filter(documents.doc_id.isin(left))
    texts = {}
    for r in scan_secrets(frame, learn_formats(frame)).collect():
        text, spans = r["text"], [tuple(s)[:3] for s in r["spans"]]
        assert [s for s in spans if not s[0].startswith("like_")] == plain_bases(text)
        marked = [any(s <= k < e for _, s, e in spans) for k in range(len(text))]
        out = "".join(("[secret]" if k == 0 or not marked[k - 1] else "") if m else text[k] for k, m in enumerate(marked))
        texts[r["doc_id"]] = out
    assert any("[secret]" in t for t in texts.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    pieces = corpus_pipeline.run(spark, planted).collect()
    met = {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        assert p["start"] == met.get(p["doc_id"], 0)
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        met[p["doc_id"]] = p["start"] + p["length"]
    assert met == {i: len(x) for i, x in ids.items()}
    places = sorted((p["sequence_id"], p["offset"], p["length"]) for p in pieces)
    at = 0
    for sequence, offset, length in places:
        assert sequence * 4096 + offset == at and offset + length <= 4096
        at += length


def test_stages_keep_the_columns_and_stand_edge_rows(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (90_001, "", "en", None, 0), (90_002, "key token = abcdef12", None, "s", 20)],
        documents.schema,
    )
    for rows in (documents.filter("doc_id < 30").union(odd), documents.limit(0)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            if name != "packing":
                assert docs.dtypes == documents.dtypes
            if name == "secrets":
                for r in docs.collect():
                    assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
                    assert not re.search("token = abcdef12", r["text"] or "")
        assert docs.count() >= 0
