import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratelake.llm import elias_fano, token_files

from .conftest import by_id

TOKENIZER = token_files.default_tokenizer()


@given(st.lists(st.integers(0, 1 << 40), max_size=300))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    values = sorted(values)
    read = elias_fano.EliasFano(elias_fano.encode(np.array(values, dtype=np.uint64)))
    assert read.values().tolist() == values and [read.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small_and_ordered():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    blob = elias_fano.encode(values)
    assert len(blob) * 8 < len(values) * 13
    read = elias_fano.EliasFano(blob)
    assert [read.select(i) for i in (0, 511, 512, 77_777, 99_999)] == values[[0, 511, 512, 77_777, 99_999]].tolist()
    with pytest.raises(IndexError):
        read.select(100_000)
    with pytest.raises(ValueError):
        elias_fano.encode(np.array([2, 1]))


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


@given(st.lists(st.text(alphabet="ab'sé1. \t\n 　\x1c", max_size=25), max_size=6))
@settings(max_examples=40, deadline=None)
def test_pieces_give_the_tokenizers_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = token_files.PieceEncoder(TOKENIZER).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("text", ["end of one <|endoftext|> next", "<|endoftext|>", "a<|endoftext|>b c", " <|endoftext|>  <|endoftext|>\n x", "<|endoftext| > <|endoftext"])
def test_added_tokens_in_a_text_get_their_own_ids(plain, text):
    got = token_files.PieceEncoder(TOKENIZER).encode(["of one next", text])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain("of one next"), plain(text)]
    assert (50256 in plain(text)) == ("<|endoftext|>" in text)


def test_full_cache_changes_nothing(plain):
    encoder = token_files.PieceEncoder(TOKENIZER, cache_bytes=40)
    for texts in (["a bb ccc dddd", "a bb"], ["eeee bb", "a ffff gg"], ["a bb", ""]):
        assert [np.frombuffer(g, "<u4").tolist() for g in encoder.encode(texts)] == [plain(t) for t in texts]
    assert 0 < encoder._table.bytes <= 40


def test_the_cache_is_bounded_in_bytes_by_long_pieces_too(plain):
    encoder = token_files.PieceEncoder(TOKENIZER, cache_bytes=20_000)
    draw = np.random.default_rng(3)
    for _ in range(6):
        texts = [" ".join("".join(map(chr, draw.integers(0x4E00, 0x9000, 400))) for _ in range(4)), " ".join(f"w{x}" for x in draw.integers(0, 900, 500))]
        assert [np.frombuffer(g, "<u4").tolist() for g in encoder.encode(texts)] == [plain(t) for t in texts]
        assert encoder._table.bytes <= 20_000


def test_blocks_of_a_long_text_and_a_second_sight(plain):
    text = " ".join(f"word{i % 70_000}" for i in range(150_000))
    encoder = token_files.PieceEncoder(TOKENIZER)
    for texts in ([text, "a b"], ["", text, " a ", "b\n", "\n a"]):
        assert [np.frombuffer(g, "<u4").tolist() for g in encoder.encode(texts)] == [plain(t) for t in texts]


def test_files_hold_all_documents(documents, plain, root):
    rows = [(i, f"text {i} of many words " * (i % 5)) for i in range(50, 0, -1)] + [(51, None), (52, ""), (53, "long " * 30_000)]
    token_files.write_tokens(documents(*rows), f"{root}/t", TOKENIZER, segment_ids=100)
    spark = documents().sparkSession
    segments = spark.read.parquet(f"{root}/t")
    start, want = 0, {}
    for i, t in sorted(rows):
        ids = np.array([*plain(t), 0], dtype="<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert by_id(token_files.read_tokens(segments), "start", "n_tokens", "ids_crc32") == want
    assert segments.count() > 3
    segment = token_files.Segment(segments.orderBy("part", "segment").first().blob)
    texts = dict(rows)
    for i, doc_id in enumerate(segment.doc_ids()):
        assert segment.ids(i).tolist() == [*plain(texts[doc_id]), 0]


def test_null_and_repeated_ids_and_empty_table(documents, root):
    got = token_files.token_index(documents((None, "a"), (2, "b"), (2, "b"), (None, "c d")), TOKENIZER).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 2), (0, 3), (2, 2), (2, 2)]
    assert sorted(r.start for r in got) == sorted({r.start for r in got})
    assert token_files.token_index(documents().limit(0), TOKENIZER).count() == 0
