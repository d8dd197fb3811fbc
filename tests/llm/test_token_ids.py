import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from meterline.llm import encoding, grammar, token_ids
from meterline.llm.encoding import TextEncoder

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, file string, row string, ids string"
TEXTS = [
    None, "", " ", " a", "a ", "a  b\n c", "  x   y", "é é  é\t é", "a.\n\nB.\nC", "×.÷x.é!", "x  y   z.",
    "she's.it'll!'re ' s", "\tA\r\nB", "a.<|endoftext|>b.c", "<|endoftext|> <|endoftext", "12.5,3 4711",
    "日本 語 text. 1", "x" * 3_000 + " y" * 50, "\n\n a \n", "ñandú, über; straße!\nWeiß",
]


@pytest.fixture(scope="module")
def model():
    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")


@pytest.fixture(scope="module")
def plain(model):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(model)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("window", [1, 7, 64, 2 << 20])
def test_pieces_give_the_ids_of_whole_texts(model, plain, monkeypatch, window):
    monkeypatch.setattr(encoding, "WINDOW", window)
    encoder, got = TextEncoder(model), {}
    for text, ids, _ in encoder.windows(pa.array(TEXTS * 2, pa.string())):
        got.setdefault(text, []).extend(ids.tolist())
    assert [got[i] for i in range(2 * len(TEXTS))] == [plain(text)[:-1] for text in TEXTS * 2]


def test_pieces_that_share_a_hash_are_told_apart(model, plain, monkeypatch):
    monkeypatch.setattr(encoding.Words, "hashes", lambda self: np.ones(len(self.start), np.uint64))
    found = {i: ids.tolist() for i, ids, _ in TextEncoder(model).windows(pa.array(TEXTS, pa.string()))}
    assert [found[i] for i in range(len(TEXTS))] == [plain(text)[:-1] for text in TEXTS]


@pytest.mark.parametrize("symbols", [1, 2, 3, 50])
@pytest.mark.parametrize("size", [0, 1, 2, 5, 60, 5_000])
def test_grammars_expand_to_what_they_were_made_of(size, symbols):
    draw = np.random.default_rng(size + symbols)
    ids = draw.integers(0, symbols, size)
    made = grammar.compress(ids, least=2)
    assert np.array_equal(made.ids(), ids)
    for _ in range(20):
        start, stop = sorted(draw.integers(0, size + 1, 2).tolist())
        assert np.array_equal(made.ids(start, stop), ids[start:stop])
    if size == 5_000:
        assert len(made.sequence) + 2 * len(made.left) < size


@pytest.mark.parametrize("least", [2, 8])
@pytest.mark.parametrize("buckets", [None, 16])
def test_no_frequent_pair_is_left(monkeypatch, least, buckets):
    """Neither rounds that gain little, nor pairs that share a bucket, nor places that are not counted leave any."""
    assert grammar.LEAST == 2
    if buckets:
        monkeypatch.setattr(grammar, "_bucket", lambda pairs: pairs % buckets)
    draw = np.random.default_rng(7)
    words = [draw.integers(0, 400, draw.integers(2, 9)) for _ in range(500)]
    for ids in (
        draw.zipf(1.3, 3_000) % 200,
        np.concatenate([words[i] for i in draw.zipf(1.2, 2_000) % 500]),
        np.repeat(draw.integers(0, 5, 300), draw.integers(1, 20, 300)),
        np.tile([1, 2, 9], 40),
        np.array([3, 3, 3, 4, 3, 4, 3, 3]),
        np.append(np.arange(50), [7, 8]),
    ):
        made = grammar.compress(ids, least)
        assert np.array_equal(made.ids(), ids)
        pairs = np.stack([made.sequence[:-1], made.sequence[1:]])
        assert np.unique(pairs, axis=1, return_counts=True)[1].max(initial=0) < least
        assert np.array_equal(made.symbol_lengths(made.left) + made.symbol_lengths(made.right), made.lengths)
        used = np.concatenate([made.left, made.right, made.sequence])
        assert set(range(made.base, made.base + len(made.left))) <= set(used.tolist())


def test_pairs_are_counted_alike_at_every_length(monkeypatch):
    shares, counted = set(), grammar._pair_counts

    def seen(keys, *rest):
        shares.add(len(keys))
        return counted(keys, *rest)

    monkeypatch.setattr(grammar, "_pair_counts", seen)
    for size in (1_001, 200_001):
        shares.clear()
        grammar.compress(np.tile(np.arange(7), size)[:size])
        assert max(shares) == (size - 1) // 2


def test_rules_of_a_round_do_not_overlap():
    draw = np.random.default_rng(1)
    pairs = np.unique((draw.integers(0, 30, 300) << 32) | draw.integers(0, 30, 300))
    counts = draw.integers(1, 9, len(pairs))
    chosen = grammar._compatible(pairs, counts, 30)
    left, right = pairs[chosen] >> 32, pairs[chosen] & 0xFFFFFFFF
    other = left != right
    assert not set(left[other]) & set(right[other]) and not set(left[~other]) & {*left[other], *right[other]}
    assert counts[chosen[0]] == counts.max() and (np.diff(counts[chosen]) <= 0).all()


def test_pieces_are_encoded_together(model, monkeypatch):
    pieces = [text.encode() for text in TEXTS if text and "<|" not in text] * 40
    encoder, calls = TextEncoder(model), []
    apart = encoder._single(pieces)
    monkeypatch.setattr(encoder, "_single", lambda raw: calls.append(len(raw)) or TextEncoder._single(encoder, raw))
    for found, wanted in zip(encoder._encoded(pieces), apart):
        assert np.array_equal(found, wanted)
    assert not calls
    pieces[3] = b" <|endoftext|>"  # holds the token that keeps them apart
    for found, wanted in zip(encoder._encoded(pieces), TextEncoder._single(encoder, pieces)):
        assert np.array_equal(found, wanted)
    assert calls == [len(pieces)]


def test_checksums_join():
    for first, second in ((0, 0), (3, 0), (0, 5), (10, 1), (100, 999), (5, 70_000)):
        a, b = random.randbytes(first), random.randbytes(second)
        assert token_ids.crc32_of_both(zlib.crc32(a), zlib.crc32(b), second) == zlib.crc32(a + b)


def report_of(spark, rows, path, model):
    docs = spark.createDataFrame([(*row, "clash", "clash", "clash") for row in rows], DOCS).repartition(3)
    found = token_ids.token_report(docs, str(path), model).collect()
    return sorted(found, key=lambda row: row["start"])


@pytest.mark.parametrize("shard_ids", [1, 40, 1 << 20])
def test_documents_read_back_as_written(spark, tmp_path, model, plain, monkeypatch, shard_ids):
    """Short shards make documents lie in several; they also come in several parts."""
    monkeypatch.setattr(token_ids, "SHARD_IDS", shard_ids)
    monkeypatch.setattr(encoding, "WINDOW", 100)
    rows = [(7 * i % 40 - 3, text) for i, text in enumerate(TEXTS)] + [(900, "long text, " * 300)]
    got, start, stream = report_of(spark, rows, tmp_path / "ids", model), 0, []
    assert len(got) == len(rows)
    for row, (doc_id, text) in zip(got, sorted(rows, key=lambda row: row[0])):
        ids = plain(text)
        want = (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert tuple(row[name] for name in ("doc_id", "start", "n_tokens", "ids_crc32")) == want
        start, stream = start + len(ids), stream + ids
    for first, last in ((0, start), (5, 6), (100, 700), (start - 3, start + 9), (4, 4)):
        assert token_ids.ids_between(spark, str(tmp_path / "ids"), first, last).tolist() == stream[first:last]


def test_nulls_repeated_rows_and_nothing(spark, tmp_path, model, plain):
    rows = [(None, "a b"), (1, "same"), (1, "same"), (1, None), (None, None)]
    got = report_of(spark, rows, tmp_path / "ids", model)
    assert [row["doc_id"] for row in got] == [None, None, 1, 1, 1]
    assert sorted(row["n_tokens"] for row in got) == sorted(len(plain(text)) for _, text in rows)
    assert [row["start"] for row in got] == np.cumsum([0] + [row["n_tokens"] for row in got])[:-1].tolist()
    assert report_of(spark, [], tmp_path / "none", model) == []


def test_files_of_few_shards_have_small_row_groups(spark, tmp_path, model, monkeypatch):
    """A reader takes a row group's shards at once, so memory must not grow with the shards of a file."""
    monkeypatch.setattr(token_ids, "SHARD_IDS", 1_000)
    monkeypatch.setattr(token_ids, "_ROW_GROUP", 40_000)
    monkeypatch.setattr(token_ids, "file_bounds", lambda docs: [])
    draw = random.Random(4)
    rows = [(i, " ".join(str(draw.randrange(10**6)) for _ in range(2_000))) for i in range(60)]
    report_of(spark, rows, tmp_path / "ids", model)
    groups = [
        file.metadata.row_group(i)
        for file in map(pq.ParquetFile, (tmp_path / "ids").glob("*.parquet"))
        for i in range(file.num_row_groups)
    ]
    assert sum(group.num_rows for group in groups) == 60
    assert max(group.total_byte_size for group in groups) < 120_000
