"""BPE and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from ratecraft.llm.bpe import Encoder, Vocabulary, encode_documents, merge_many, merge_tree
from ratecraft.llm.token_output import WordEncoder, read_token_files, token_digest, write_token_files

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


def library(path):
    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    parts = " \n\t\r  　ab1'sé!😀́\x1c\x85٣ΣİK"
    out = ["", " ", "a", " a", "  a", "a  b ", "a \n b", "it's I'LL  we've", "a<|endoftext|> b <|endoftext|><|endoftext|>", "<|startoftext|>x", "日本語 テスト ‍", "x" * 5000, "ab " * 300]
    out += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    return out


def test_encoder_equals_the_library(texts):
    t, e = library(BYTE), Encoder(Vocabulary(BYTE))
    for x, raw in zip(texts, e.encode_many(texts), strict=True):
        ids = np.frombuffer(raw, "<u4")
        expected = t.encode(x, add_special_tokens=False).ids
        assert ids.tolist() == expected, x[:50]
        assert e.decode(ids) == t.decode(expected, skip_special_tokens=False)


def test_both_segment_trees_merge_alike():
    v, rng = Vocabulary(BYTE), random.Random(2)
    words = [bytes(rng.choice(b" theandoring") for _ in range(n)) for n in range(1, 65) for _ in range(8)]
    for w, raw in zip(words, merge_many(words, v), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == merge_tree([v.byte_ids[b] for b in w], v.merges)


def test_word_encoder_equals_the_library(texts):
    t, e = library(WORD), WordEncoder(WORD)
    for x, raw in zip(texts, e.encode_many(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_word_encoder_splits_latin_words_as_the_library(texts):
    t, e = library(WORD), WordEncoder(WORD)
    assert e.plain
    rng = random.Random(8)
    parts = [*"aZéÉßØøÿÀ×÷µªº09.,;-_^~<>'\"", "<|endoftext|>", "don't", "ab", "ÉCOLE", "\u0301", "¡", "A\u030a"]
    words = [" ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(5)) for _ in range(2000)]
    for round_ in range(2):  # met for the first time, then remembered
        for x, raw in zip(words, e.encode_many(words), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, (round_, x)
    e.plain = False
    e._forget()
    assert [x.tolist() for x in e.encode(words)] == [x.tolist() for x in WordEncoder(WORD).encode(words)]
    assert e.encode([])[0].tolist() == [] and e.encode([None, ""])[1].tolist() == [0, 0]


def test_forgetting_changes_nothing(texts, monkeypatch):
    from ratecraft.llm import token_output

    whole = [WordEncoder(WORD).encode(texts)[0].tolist()]
    monkeypatch.setattr(token_output, "CACHE_WORDS", 50)
    e = WordEncoder(WORD)
    assert [i for k in range(0, len(texts), 7) for i in e.encode(texts[k : k + 7])[0].tolist()] == whole[0]


def test_bpe_query(make_docs):
    rows = [(1, "A b  c"), (1, "A b  c"), (2, None), (None, "x"), (3, "")]
    t = library(BYTE)
    out = encode_documents(make_docs(rows), BYTE, with_text=True).collect()
    expected = []
    for i, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest(), ids, x or ""))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, expected))
    assert encode_documents(make_docs([]), BYTE).count() == 0


def test_token_files(spark, make_docs, corpus, tmp_path):
    t = library(WORD)
    out = token_digest(make_docs(corpus), WORD).collect()
    start, expected = 0, []
    for i, x in corpus:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out)) == expected
    assert token_digest(make_docs([]), WORD).count() == 0
    # rows of one doc_id have an order of their own, whatever order they are read in
    tied = [(4, f"text {k} " * (k + 1)) for k in range(12)] + [(None, "x y"), (None, None)]
    one, other = (sorted(map(tuple, token_digest(make_docs(x), WORD).collect()), key=str) for x in (tied, tied[::-1]))
    assert one == other
    rows = token_digest(make_docs([(None, "a"), (4, "b c"), (4, "b c"), (5, None)]), WORD).collect()
    assert sorted((r.start, r.n_tokens) for r in rows) == [(0, 2), (2, 3), (5, 3), (8, 1)]

    # the files themselves: order, encodings, page indexes, selective reads
    write_token_files(make_docs(corpus), WORD, str(tmp_path))
    for f in sorted((tmp_path / "data").glob("*.parquet")):
        meta = pq.read_metadata(f)
        ids = pq.read_table(f, columns=["doc_id"]).column(0).to_pylist()
        assert ids == sorted(ids)
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema.split(".")[0]: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            assert all(c.has_offset_index for c in columns.values())
            assert any("DELTA" in e for e in columns["doc_id"].encodings)
            assert any("DICTIONARY" in e for e in columns["ids"].encodings)
    plan = read_token_files(spark, str(tmp_path)).select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_only_distinct_pieces_of_a_round_are_looked_up(monkeypatch):
    from ratecraft.llm import token_output

    asked, numbers = [], token_output._numbers

    def counted(known, texts):
        texts = list(texts)
        asked.append(len(texts))
        return numbers(known, texts)

    monkeypatch.setattr(token_output, "_numbers", counted)
    rng = random.Random(3)
    words = ["".join(rng.choice("aeiounrst") for _ in range(6)) for _ in range(40)]
    cased = [f(w) + end for w in words for f in (str, str.upper, str.title) for end in ("", ",", ".")]
    texts = [" ".join(rng.choices([*cased, "don't", "l\u2019eau"], k=500)) for _ in range(20)]
    t, e = library(WORD), WordEncoder(WORD)
    expected = [t.encode(x, add_special_tokens=False).ids for x in texts]
    for _ in range(2):  # met for the first time, then remembered
        asked.clear()
        assert [np.frombuffer(raw, "<u4").tolist() for raw in e.encode_many(texts)] == expected
        # 40 words in any case, two signs and two odd words, whatever stands in the 10,000 places
        assert sum(asked) <= 44


def test_rounds_of_any_size_change_nothing(texts, monkeypatch):
    from ratecraft.llm import token_output

    t, rng = library(WORD), random.Random(6)
    wide = " \x85\xa0\u1680\u2000\u200a\u200b\u2028\u202f\u205f\u3000\x1c\x1fÀÿß×÷aZ5.'<\u0301\U0001f600"
    some = [*texts[:60], None, "", *("".join(rng.choice(wide) for _ in range(rng.randint(0, 40))) for _ in range(400)), "Ab1,\u3000é " * 90, "ab", "cd"]
    expected = [t.encode(x or "", add_special_tokens=False).ids for x in some]
    for size in (1, 20, 333, 1 << 20):
        monkeypatch.setattr(token_output, "ROUND_BYTES", size)
        e = WordEncoder(WORD)
        assert [np.frombuffer(raw, "<u4").tolist() for raw in e.encode_many(some)] == expected, size


@pytest.mark.parametrize(("part", "field", "value"), [("model", "end_of_word_suffix", None), ("normalizer", "normalizers", [{"type": "NFC"}, {"type": "Lowercase"}])])
def test_other_tokenizer_files_get_whole_words(texts, tmp_path, part, field, value):
    spec = json.loads(Path(WORD).read_text(encoding="utf-8"))
    spec[part][field] = value
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    t, e = library(str(path)), WordEncoder(str(path))
    assert not e.plain
    for x, raw in zip(texts[:300], e.encode_many(texts[:300]), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)
