"""What a task holds at once does not grow with the batches or blocks it is given."""

import pyarrow as pa
import public_tokenizers
import pytest

from knownby.llm import bpe, common, quality

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture
def arrow_bytes(spark):
    before = spark.conf.get(common._ARROW_BYTES)
    spark.conf.set(common._ARROW_BYTES, "64m")
    yield lambda: int(str(spark.conf.get(common._ARROW_BYTES)).removesuffix("b"))
    spark.conf.set(common._ARROW_BYTES, before)


def _batches(texts, rows):
    return (pa.RecordBatch.from_arrays([pa.array(range(i, i + len(part)), pa.int64()), pa.array(part, pa.string())],
                                       ["doc_id", "text"])
            for i in range(0, len(texts), rows) for part in [texts[i:i + rows]])


def test_blocks_do_not_depend_on_batches():
    texts = ["one two", None, "three", "", "two two", "four", "one two three"]
    cut = bpe._blocks(public_tokenizers.PATTERN, 14, 8)
    found = [[b.to_pylist() for b in cut(_batches(texts, rows))] for rows in (1, 2, 7)]
    assert len(found[0]) == 3
    assert found[0] == found[1] == found[2]


def test_assembled_ids_leave_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_IDS", 50)
    texts = [f"word {i} of many" for i in range(100)]
    [block] = bpe._blocks(public_tokenizers.PATTERN, 10_000, 1)(_batches(texts, 100))
    [spread] = bpe._spread(iter([block]))
    encode = bpe._encode_words(type("Shared", (), {"value": RANKS}))
    table = bpe._assemble((), pa.Table.from_batches([block]), pa.Table.from_batches(encode(iter([spread]))))
    assert table.num_rows == 100
    sizes = [len(b["ids"].flatten()) for b in table.to_batches()]
    assert len(sizes) > 5 and max(sizes) < 60


def test_decoding_needs_no_python_worker(spark):
    rows = [(1, [65, 300, 65], None), (2, [], None), (3, [49_999], None), (None, None, None)]
    ids = spark.createDataFrame(rows, "doc_id long, ids array<int>, more string")
    decoded = bpe.decode(ids, RANKS)
    tokens = {rank: token for token, rank in RANKS.items()}
    assert {r["doc_id"]: r["bytes"] for r in decoded.collect()} == {
        i: b"".join(tokens.get(x, b"") for x in found or []) for i, found, _ in rows}
    assert "Arrow" not in decoded._jdf.queryExecution().executedPlan().toString()


def test_python_gets_small_batches(spark, arrow_bytes):
    docs = spark.createDataFrame([(i, "x" * 1_000_000) for i in range(8)], "doc_id long, text string").coalesce(1)
    seen = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert arrow_bytes() == common.BATCH_BYTES
    assert seen.count() == 8
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long")
    assert max(r["n"] for r in sizes.collect()) < 2 * common.BATCH_BYTES


@pytest.mark.parametrize("plan", [quality.keep_good, quality.quality_scores])
def test_quality_plans_get_small_batches(spark, arrow_bytes, plan):
    model = quality.QualityModel(quality.np.zeros((quality.BINS, quality.DIM)), quality._constant(0.5))
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert plan(docs, model).count() == 1
    assert arrow_bytes() == common.BATCH_BYTES
