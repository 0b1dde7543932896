import base64

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewheel.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
REFERENCE = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)


def test_perfect_hash_is_minimal_and_total():
    keys = list(RANKS)
    h = bpe.PerfectHash(keys)
    slots = h.slots(bpe.hashes_of(keys))
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert (h.slot_key[slots] == np.arange(len(keys))).all()


@pytest.mark.parametrize("keys", [[], [b"a"], [b"a", b"b"], [bytes([i, j]) for i in range(20) for j in range(20)]])
def test_perfect_hash_small(keys):
    h = bpe.PerfectHash(keys)
    assert sorted(h.slots(bpe.hashes_of(keys)).tolist()) == list(range(len(keys)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=8))
def test_encodes_as_tiktoken_does(texts):
    v = _V
    ids, counts = v.encode(texts)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    for t, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert ids[a:b].tolist() == REFERENCE.encode_ordinary(t)
    assert v.decode(ids, offsets.astype(np.int64)) == [t.encode() for t in texts]


_V = bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)


def test_long_pieces(vocabulary):
    for t in ("a" * 20_000, "ab" * 5_000, " " * 3_000 + "x", "日本" * 2_000, "\x1c \x85  \n\n"):
        ids, _ = vocabulary.encode([t])
        assert ids.tolist() == REFERENCE.encode_ordinary(t)


def test_frame(spark, vocabulary):
    rows = [(1, "hello world", 5), (2, None, 6), (2, None, 6), (3, "", 7), (None, "x y", 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = bpe.decode(bpe.encode(df, vocabulary), vocabulary).collect()
    assert len(out) == 5
    by = {r.doc_id: r for r in out}
    assert by[1].ids == REFERENCE.encode_ordinary("hello world") and bytes(by[1].decoded) == b"hello world"
    assert by[2].ids == [] and bytes(by[2].decoded) == b"" and by[3].ids == []
    assert bpe.encode(df.limit(0), vocabulary).count() == 0
    odd = spark.createDataFrame([(None,), ([0, 10**8],)], "ids array<int>")
    got = [bytes(r.decoded) for r in bpe.decode(odd, vocabulary).collect()]
    assert got[0] == b"" and got[1].endswith("�".encode())
    digests = {r.doc_id: r for r in bpe.digests(bpe.round_trip(df, vocabulary)).collect()}
    assert digests[3].n_tokens == 0 and digests[3].ids_sha256 == digests[3].decoded_sha256


def _merged(monkeypatch, vocabulary):
    """The pieces that vocabulary merges from now on, in order."""
    seen, merge = [], vocabulary.merge
    monkeypatch.setattr(vocabulary, "merge", lambda piece: seen.append(piece) or merge(piece))
    return seen


def test_a_word_in_use_is_merged_once_however_many_others_pass(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 200)
    v = bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)
    seen = _merged(monkeypatch, v)
    for i in range(12):
        text = "qzxvqzxv " + " ".join(f"zq{chr(97 + i)}xj{chr(97 + k // 26)}{chr(97 + k % 26)}qk" for k in range(150))
        ids, _ = v.encode([text])
        assert ids.tolist() == REFERENCE.encode_ordinary(text)
    assert seen.count(b"qzxvqzxv") == 1 and len(set(seen)) == 1 + 12 * 150


def test_what_is_remembered_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50_000)
    v = bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)
    for i in range(20):
        ids, _ = v.encode([t := " ".join(chr(97 + i) * (1000 + k) for k in range(10))])
        assert ids.tolist() == REFERENCE.encode_ordinary(t)
    remembered = {**v._memo, **getattr(v, "_older", {})}
    assert sum(map(len, remembered)) < 2 * 50_000


def test_decodes_a_column_as_bytes(vocabulary):
    texts = ["", "hello  wörld", "", "日本 \x00", "x" * 1000, ""]
    ids, offsets = vocabulary.encode_column(pa.array(texts + [None]))
    got = vocabulary.decode_column(ids, offsets)
    got.validate(full=True)
    assert got.type == pa.binary() and got.to_pylist() == [t.encode() for t in texts] + [b""]
    none = vocabulary.decode_column(np.empty(0, np.int32), np.zeros(1, np.int32))
    none.validate(full=True)
    assert len(none) == 0
    assert vocabulary.decode(np.array([-1, 10**8]), np.array([0, 1, 2])) == ["�".encode()] * 2
