"""The BPE automaton and the id files against the tokenizers library."""

import hashlib
import random
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pulsefold.llm import bpe, simple8b
from pulsefold.llm.presplit import ChunkCoder, Remembering
from pulsefold.llm.queries import vocabulary_path

ODD = ["", "a  b", " a", "a ", "\n x", "hello world's don't", "aaaaaaaaa aaaa", "<|endoftext|>", "a\n <|endoftext|>b  <|endoftext|>",
       "\x1c x \x85y", " 　z", "日本語 テスト", "1234567 89", "''s 's", "é́ ñ", "\t\tx", "👩‍👩‍👧 ok", "the the  the", "x" * 3000, " " * 50]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def test_automaton_equals_library(library):
    draw = random.Random(3)
    rows = ODD + ["".join(draw.choice("abcdeothin  \n\t'.,-13éßñ日 AB!$&\x1f\x85") for _ in range(draw.randint(0, 60))) for _ in range(1500)]
    vocabulary = bpe.Vocabulary.from_file(vocabulary_path())
    ids, counts = ChunkCoder(bpe.Automaton(vocabulary).encode_many, vocabulary.specials).encode(pa.array(rows))
    want = [e.ids for e in library.encode_batch_fast(rows, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert [x.decode() for x in bpe.Decoder(vocabulary.labels).decode(ids, counts)] == rows


def test_decoding_takes_little_more_room_than_the_bytes():
    ids, counts = np.tile(np.array([3, 0, 2, 1], np.uint32), 1_000_000), np.array([1_000_001, 0, 2_999_999])
    tracemalloc.start()
    try:
        texts = bpe.Decoder([b"ab", b"c", b"defgh", b" ijklmn"]).decode(ids, counts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    whole = b" ijklmnabdefghc" * 1_000_000
    assert texts == [whole[:15 * 250_000 + 7], b"", whole[15 * 250_000 + 7:]]
    assert peak < 12 * len(whole)


def test_texts_are_encoded_in_small_runs(spark):
    docs = spark.range(40, numPartitions=1).selectExpr("id AS doc_id", "repeat('ab cd ', 50000) AS text")
    in_run = bpe._each(docs, vocabulary_path(), lambda ids, counts, tables: [pa.array(np.full(len(counts), len(counts)))], "in_run long")
    rows = in_run.collect()
    assert sorted(r.doc_id for r in rows) == list(range(40))
    assert max(r.in_run for r in rows) * 300_000 <= 2_000_000


def test_the_library_leaves_other_cores_to_other_tasks(library, monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    coder = simple8b.LibraryCoder(library)
    assert simple8b.os.environ["TOKENIZERS_PARALLELISM"] == "false"
    ids, counts = coder.encode_many(pa.array([" ab", " cd", "ef"]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in (" ab", " cd", "ef")]


@pytest.mark.parametrize("most", [0, 3, 40, 10_000])
def test_chunks_are_encoded_once_as_far_as_there_is_room(library, most):
    draw, asked = random.Random(5), []
    specials = {t.content: k for k, t in library.get_added_tokens_decoder().items()}
    plain = simple8b.LibraryCoder(library).encode_many

    def noted(texts):
        asked.extend(texts.to_pylist())
        return plain(texts)

    coder = ChunkCoder(plain, specials, Remembering(noted, most))
    for _ in range(4):
        rows = ODD + [" ".join(draw.choice(["ab", "the", "x" * 70, "é", "1,2"]) + str(draw.randint(0, 9)) for _ in range(8)) for _ in range(20)]
        ids, counts = coder.encode(pa.array(rows))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in library.encode_batch_fast(rows, add_special_tokens=False)]
        assert len(coder.encode_chunks.known) <= most
    short = [x for x in asked if x.startswith(" ") and len(x) < 60]
    assert (len(short) == len(set(short))) == (most == 10_000)


def test_decoding_of_broken_utf8(library):
    vocabulary = bpe.Vocabulary.from_file(vocabulary_path())
    ids = library.encode("日本é", add_special_tokens=False).ids
    for cut in range(len(ids) + 1):
        got = bpe.Decoder(vocabulary.labels).decode(np.array(ids[:cut], np.int64), np.array([cut]))[0].decode()
        assert got == library.decode(ids[:cut], skip_special_tokens=False)


def test_small_merge_lists():
    """Every string over a small alphabet, against applying the merges one by one."""
    merges = ["a a", "a b", "aa a", "ab b", "b a", "aa ab", "b b", "bb a"]
    labels = [b"a", b"b"]
    for m in merges:
        labels.append(m.replace(" ", "").encode())
    number = {x: k for k, x in enumerate(labels)}
    rows = [[number[u.encode()], number[v.encode()], number[(u + v).encode()]] for u, v in (m.split() for m in merges)]
    automaton = bpe.Automaton(bpe.Vocabulary(labels, np.array(rows, np.int32), {}))
    for n in range(1, 10):
        for k in range(2**n):
            word = format(k, f"0{n}b").replace("0", "a").replace("1", "b").encode()
            seq = [number[word[i:i + 1]] for i in range(n)]
            for u, v, w in rows:
                i, out = 0, []
                while i < len(seq):
                    both = seq[i:i + 2] == [u, v]
                    out.append(w if both else seq[i])
                    i += 2 if both else 1
                seq = out
            assert automaton.encode_word(word) == seq, word


def test_encode_query_rows(spark, frame, library):
    docs = frame("doc_id long, text string, ids string", *[(k, t, "clash") for k, t in enumerate(ODD)], (99, None, "x"), (7, ODD[7], "again"))
    rows = bpe.encode_and_decode(docs, vocabulary_path(), with_ids=True, with_text=True).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = ODD[r.doc_id] if r.doc_id < len(ODD) else ""
        want = library.encode(text, add_special_tokens=False).ids
        assert (r.ids, r.n_tokens, r.decoded) == (want, len(want), text)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_and_decode(docs.limit(0), vocabulary_path()).count() == 0


@pytest.mark.parametrize("kind", range(4))
def test_packing_round_trip(kind):
    draw = np.random.default_rng(kind)
    for _ in range(60):
        n = int(draw.integers(0, 3000))
        values = [draw.integers(0, 50257, n), draw.integers(0, 2 ** int(draw.integers(1, 20)), n),
                  np.where(draw.random(n) < 0.02, draw.integers(2**60, 2**63, n), draw.integers(0, 9, n)),
                  draw.integers(2**59, 2**64 - 1, n, dtype=np.uint64)][kind].astype(np.uint64)
        block = int(draw.integers(1, 1500))
        words, first = simple8b.pack(values, block)
        assert (simple8b.unpack(words, first, n, block) == values).all()
    ids, counts = np.array([3, 9]), np.array([2, 1])
    got = simple8b.from_file(simple8b.to_file(ids, counts, np.array([5, 0, 0]), 2), 2)
    assert [x.tolist() for x in got] == [[3, 9], [2, 1], [5, 0, 0]]
    with pytest.raises(ValueError):
        simple8b.from_file(b"something else", 2)


def test_files_in_order(spark, frame, library):
    settings = simple8b.Settings(file_values=40)
    rows = [(k * 7 % 20, ODD[k]) for k in range(20)] + [(5, "twice"), (5, "twice"), (None, None)]
    docs = frame("doc_id long, text string, start string", *[(d, t, "clash") for d, t in rows])
    files = simple8b.write(docs, vocabulary_path(), settings)
    assert files.count() > 1
    got = sorted(simple8b.read(spark, files, settings).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *sorted(d for d, _ in rows if d is not None)]
    at, texts = 0, {}
    for d, t in rows:
        texts.setdefault(d, []).append(t or "")
    for r in got:
        assert r.start == at
        at += r.n_tokens
        want = [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts[r.doc_id]]
        assert (r.n_tokens, r.ids_crc32) in [(len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for w in want]
    assert simple8b.read(spark, simple8b.write(docs.limit(0), vocabulary_path())).count() == 0


def test_a_missing_file_is_an_error(spark, frame):
    docs = frame("doc_id long, text string", *[(d, "some text " * d) for d in range(40)])
    files = simple8b.write(docs, vocabulary_path(), simple8b.Settings(file_values=40))
    assert simple8b.read(spark, files).count() == 40
    lost = files.orderBy("name").first()
    Path(lost["folder"].removeprefix("file://"), lost["name"]).unlink()
    with pytest.raises(Exception, match="is missing"):
        simple8b.read(spark, files).collect()


def test_steps_side_by_side_equal_the_single_automaton():
    automaton = bpe.Automaton(bpe.Vocabulary.from_file(vocabulary_path()))
    tables, draw = bpe.Tables(automaton), np.random.default_rng(3)
    u, w = (draw.choice(np.array(list(automaton.token.values())), 20_000) for _ in range(2))
    assert tables.has_arcs(u, w).tolist() == [automaton.has_arc(a, b) for a, b in zip(u.tolist(), w.tolist(), strict=True)]
    letters = list("etaoin shrdlu") + ["é", "ß", "  ", "\n", "1", "!", "'s", "\u4e2d", "\u3000"]
    texts = ["".join(draw.choice(letters, draw.integers(0, 200))) for _ in range(300)] + ["x" * 500, "", "aab" * 60]
    ids, counts = automaton.encode_many(texts)
    ends = np.cumsum(counts)
    pieces = automaton._tables.pieces
    want = [[t for p in pieces.findall(x) for t in automaton.encode_word(p.encode())] for x in texts]
    assert [ids[e - n:e].tolist() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)] == want
