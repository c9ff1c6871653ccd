import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tellurion.llm import huffman, packing, textops
from tellurion.llm.common import BATCH_ROWS, released, staged
from tellurion.llm.tokens import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "Hello, world! it's 12 345", "", None, " a", "a ", "a  b", "a\n b c\n\nd", "x  y z", "\x1c a b\x1d c",
    "été ñandú 日本 語 テスト", "<|endoftext|> x", "   ", "a <|endoftext|> b<|endoftext|><|endoftext|> c  <|endoftext|>\n<|endof text|> d<|endoftext|>e", "a b c " * 900, "word\tnext \r\n end", "x" * 5000,
    "word, word. word word, né. né , . .. ,, a.b, c., it's. 12. 12, x. x",
]


def whole(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("most", [2, 400_000])
def test_pieces_give_the_ids_of_whole_texts(most):
    encoder = PieceEncoder(PATH, max_pieces=most, recent=1)
    for _ in range(2):
        ids, counts = encoder.encode(TEXTS)
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == whole(TEXTS)


@pytest.mark.parametrize("bits", [5, 16])
def test_code_is_prefix_free_and_round_trips(bits):
    rng = np.random.default_rng(1)
    symbols = np.array([0, 3, 4, 9, 17, 300, 301, 999])
    counts = np.array([1, 1, 2, 5, 30, 200, 4000, 90000])
    lengths = huffman.code_lengths(counts, bits)
    assert lengths.max() <= bits and (2.0 ** -lengths).sum() <= 1
    code = huffman.Code(symbols, lengths)
    for n in (0, 1, 255, 256, 257, 5000):
        ids = rng.choice(symbols, n, p=counts / counts.sum()).astype(np.uint32)
        data, total, points = code.encode(ids)
        assert len(data) == (total + 7) // 8
        assert (code.decode(data, n, points) == ids).all()


def test_single_symbol():
    code = huffman.Code(np.array([7]), huffman.code_lengths(np.array([5]), 16))
    data, _, points = code.encode(np.full(300, 7, np.uint32))
    assert (code.decode(data, 300, points) == 7).all()


def documents(spark):
    rows = [(i * 3, t, "n") for i, t in enumerate(TEXTS)] + [(None, "no id", "n"), (6, "same id", "n")]
    return spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)


def test_huffman_files(spark, tmp_path):
    docs = documents(spark)
    huffman.write(docs, f"file://{tmp_path}/a", PATH, end_id=2)
    got = [tuple(r) for r in huffman.read(spark, f"file://{tmp_path}/a").collect()]
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    want, start = [], 0
    for row in rows:
        ids = whole([row.text])[0] + [2]
        want.append((row.doc_id, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    assert spark.read.parquet(f"file://{tmp_path}/a/blocks").count() >= 1


def test_files_are_in_ascending_order(spark, tmp_path):
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 99, rng.integers(0, 60) ** 2))) for _ in range(300)]
    rows = [(int(i), t) for i, t in zip(rng.permutation(300), texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    huffman.write(docs, f"file://{tmp_path}/c", PATH, end_id=2)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = sorted(map(str, (tmp_path / "c/blocks").rglob("*.parquet")))
    found = [pq.ParquetFile(f).read() for f in files]
    starts = [s for t in found for s in t["start"].to_pylist()]
    assert len(files) > 1 and starts == sorted(starts)
    assert [d for t in found for block in t["doc_ids"].to_pylist() for d in block] == list(range(300))


def test_huffman_of_an_empty_table(spark, tmp_path):
    huffman.write(documents(spark).where("false"), f"file://{tmp_path}/b", PATH, end_id=2)
    assert huffman.read(spark, f"file://{tmp_path}/b").count() == 0


def test_equal_rows_are_dealt_into_groups(spark):
    docs = spark.createDataFrame([(None, "")] * 4000 + [(1, "same text")] * 2000, "doc_id long, text string")
    rows = packing.pack(docs, PATH, end_id=0, capacity=64, group_rests=500).collect()
    groups = [r.sequence_id >> 32 for r in rows]
    assert len(rows) == 6000 and len(set(groups)) == 12
    assert max(groups.count(g) for g in set(groups)) < 700


def test_first_fit_is_the_plain_one():
    rng = np.random.default_rng(2)
    lengths = sorted(rng.integers(1, 101, 300).tolist(), reverse=True)
    bins, offsets = packing.first_fit(lengths, 100)
    used = []
    for length, b, at in zip(lengths, bins, offsets):
        first = next((i for i, u in enumerate(used) if u + length <= 100), len(used))
        if first == len(used):
            used.append(0)
        assert (b, at) == (first, used[first])
        used[first] += length


def test_pieces_fill_sequences(spark):
    docs = documents(spark)
    rows = packing.pack(docs, PATH, end_id=0, capacity=64, group_rests=4).collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and 1 <= r.length <= 64
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    got = sorted(crc(np.frombuffer(b"".join(i for _, i in sorted(p)), "<u4")) for p in by_doc.values())
    want = {}
    for r in docs.collect():
        ids = whole([r.text])[0] + [0]
        want.setdefault((r.doc_id, len(ids)), []).append(ids)
    assert all(len(v) == 1 for v in want.values())
    assert got == sorted(crc(v[0]) for v in want.values())
    assert packing.pack(docs.where("false"), PATH, end_id=0).count() == 0


def test_lean_cutting_encodes_little_at_a_time_and_gives_memory_back(monkeypatch):
    given_back, sizes = [], []
    monkeypatch.setattr(packing, "trim", lambda: given_back.append(1))
    encode = PieceEncoder.encode
    monkeypatch.setattr(PieceEncoder, "encode", lambda self, texts: sizes.append(texts.nbytes) or encode(self, texts))
    texts = ["ab cd " * 10_000, None, "x y"] * 30
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    made = pa.Table.from_batches(packing.cut_batch(batch, PATH, 0, 1024, lean=True)).to_pylist()
    assert len(sizes) > 3 and max(sizes) < 600_000 and len(given_back) == 1
    ids = {t: [*own, 0] for t, own in zip(texts[:3], whole(texts[:3]))}
    for i in range(len(texts)):
        pieces = [p for p in made if p["doc_id"] == i]
        assert np.concatenate([np.frombuffer(p["ids"], "<u4") for p in pieces]).tolist() == ids[texts[i]]
        assert {p["doc_tokens"] for p in pieces} == {len(ids[texts[i]])}


def test_a_released_task_starts_without_the_powers_of_earlier_ones():
    textops.powers(1 << 20)
    list(released(lambda batches: batches)(iter([])))
    assert len(textops._POWERS[0]) == 1
    power, inverse = textops.powers(1000)
    assert (power * inverse == 1).all() and len(power) == 1000


def test_a_staged_write_can_bound_its_batches(spark):
    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    before = spark.conf.get(BATCH_ROWS)
    rows = spark.range(0, 5000, 1, 1).mapInArrow(size, "n long")
    assert max(r.n for r in staged(rows, "bounded", 700).collect()) == 700
    assert max(r.n for r in staged(rows, "unbounded").collect()) == 5000
    assert spark.conf.get(BATCH_ROWS) == before
