import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordlog.llm import token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(WORD_BPE)
    out.encode_special_tokens = True
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_the_coding_round_trips(values):
    control, data = token_files.encode(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert token_files.decode(control, data, len(values)).tolist() == values


def test_small_ranks_take_one_byte():
    control, data = token_files.encode(np.array([0, 255, 256, 65535, 65536, 2**24], np.uint32))
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 4 and len(control) == 2


def want(rows, tokenizer):
    """By id, nulls first; rows of one id in any order."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_real_documents(real, tokenizer):
    got = sorted(map(tuple, token_files.report(real, WORD_BPE, spaced=True).collect()))
    assert got == want([(r.doc_id, r.text) for r in real.collect()], tokenizer)


TRICKY = [
    "I'm here, you've gone: it's DON'T 'quoted' rock'n'roll",
    "ÀÉÎõü naïve Straße İstanbul ΣΊΣΥΦΟΣ ǅ ſ ﬁ",
    "é café 가 Å",
    "a b c　d\x0be\x0cf\x1cg\x85h\x00i",
    "x1y22z333 4.5 1,000 ½ ² Ⅷ",
    "wait... what?! (yes) [no] {maybe} $5 100% a_b _ __ -- !!",
    "<|endoftext|> <|startoftext|>word<|endoftext|>",
    "東京 🙂🙂 👩‍👩‍👧 العربية हिन्दी",
    "word word. Word, WORD! word'",
    "'s 't 're s' ''",
    "",
    "   ",
]


def test_pieces_are_encoded_as_whole_texts_are(docs, tokenizer):
    table = docs(TRICKY + [None])
    rows = [(r.doc_id, r.text) for r in table.collect()]
    for spaced in (True, False):
        got = sorted(map(tuple, token_files.report(table, WORD_BPE, spaced=spaced).collect()))
        assert got == want(rows, tokenizer)


NAMED = [
    "hello <|endoftext|> world",
    "A<|endoftext|>B it'<|startoftext|>S Ünï<|startoftext|><|endoftext|>. <|ENDOFTEXT|> <|endoftext |>",
    "ends in <|endof",
    "text|> begins so <|endoftext|>",
    "<|endoftext|>",
    "x<|endoftext|>\u3000Y \t<|endoftext|>\n",
]


def test_names_of_added_tokens_are_tokens_as_by_default(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    default = Tokenizer.from_file(WORD_BPE)
    assert 49407 in default.encode(NAMED[0], add_special_tokens=False).ids
    table = docs(TRICKY + NAMED + [None]).coalesce(1)
    wanted = want([(r.doc_id, r.text) for r in table.collect()], default)
    for spaced in (True, False):
        got = token_files.report(table, WORD_BPE, spaced=spaced, special=True).collect()
        assert sorted(map(tuple, got)) == wanted
    table.write.parquet(str(tmp_path / "documents.parquet"))
    import corpus_pipeline
    from ordlog.llm import queries

    assert sorted(map(tuple, queries.op7_token_files(spark, str(tmp_path)).collect())) == wanted
    assert sorted(map(tuple, corpus_pipeline.token_ids(spark, table, str(tmp_path)).collect())) == wanted


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB'é.,!s \t1_ßİé "), max_size=20))
def test_pieces_of_any_text(text):
    pieces = token_files.pieces_of(WORD_BPE, "<u2")
    got = [i for p in text.encode().split() for i in pieces.piece(p.lower())]
    assert got == pieces.whole(text.encode())


def test_what_is_remembered_is_bounded(monkeypatch, tokenizer):
    import pyarrow as pa

    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    pieces = token_files._Pieces(WORD_BPE, "<u2")
    for k in range(8):
        text = " ".join(f"w{chr(97 + k)}{chr(97 + i)}" for i in range(15)) + " again Again AGAIN"
        w = next(token_files.words.split_texts(pa.array([text]), token_files.words.SPACED))[2]
        ids, size = pieces.encode(w)
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids and size.sum() == len(ids)
        assert len(pieces.hashes) <= 20 + 16


def test_reading_gives_the_ids_back(spark, docs, tokenizer, tmp_path):
    texts = ["one two three", "", "two two", None]
    staged, kind = token_files.tokens(docs(texts), WORD_BPE, spaced=True)
    manifest, table = token_files.write(staged, kind, str(tmp_path / "files"))
    back = token_files.read(spark, manifest, str(tmp_path / "files"), table)
    got = {r.id: r.ids for r in back.collect()}
    assert got == {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    assert table[0] == 1  # the end id is the most frequent one


def test_blocks_of_a_file(docs, monkeypatch):
    ids = [list(range(5)), [], [7] * 3]
    raw = token_files._block([3, None, 9], [5, 0, 3], [np.array(x, np.uint32) for x in ids])
    assert np.frombuffer(raw[:24], "<i8")[:2].tolist() == [3, 8]


def test_nasty_rows(nasty, none):
    clash = nasty.withColumnRenamed("n_chars", "ids").withColumnRenamed("lang", "start")
    got = token_files.report(clash, WORD_BPE, spaced=True).collect()
    assert len(got) == nasty.count() and sum(r.doc_id is None for r in got) == 2
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert token_files.report(none, WORD_BPE, spaced=True).count() == 0
