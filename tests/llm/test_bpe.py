from __future__ import annotations

import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retailgold.llm import bpe
from retailgold.llm.lexicon import Lexicon, compile_lexicon

from .conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = [*"abcdeE'sStTrRvVeElLdDmM  \n\t\x1c\x1d\x85\xa0 　éÉÇßΣςσİıſ½²³中文字😀​\x00.,;!?-_<>|0123ä́iǅﬁẞͅｱ가", "<|endoftext|>", "<|startoftext|>", "'ll"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_same_as_the_library_with_and_without_lexicon(library):
    draw = random.Random(5)
    texts = ["".join(draw.choices(SIGNS, k=draw.randint(0, 50))) for _ in range(4_000)] + ["a" * 3_000, "!?" * 900, "ab" * 1_000 + " x"]
    rules = bpe.WordBpe(PATH)
    words = {w.encode("utf-8"): rules.merge(w.encode("utf-8")) for t in texts[::2] for c in rules.chunks(t) for w in rules.pieces(c) if w not in rules.special}
    for block in (compile_lexicon(words), compile_lexicon({})):
        got = bpe.Encoder(rules, block).encode(texts)
        for text, ids in zip(texts, got):
            want = library.encode(text, add_special_tokens=False).ids
            assert ids == want, text
            assert rules.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_memory_of_chunks_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_CHUNKS", 3)
    rules = bpe.WordBpe(PATH)
    encoder = bpe.Encoder(rules, compile_lexicon({}))
    for text in ("one two three four", "five six one", "seven, two eight"):
        assert encoder.encode([text])[0] == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 3 + 4


def test_words_merged_together_are_merged_alike():
    rules, draw = bpe.WordBpe(PATH), random.Random(9)
    words = ["".join(draw.choices("abcdehinorstu\xe9\u0111!0", k=draw.randint(1, 60))).encode() for _ in range(5_000)] + [b"a" * 40, b"aaaa"] * 20
    assert rules.merge_all(words) == [rules.merge(w) for w in words]
    assert rules.merge_all([]) == [] and rules.merge_all([b"x"]) == [rules.merge(b"x")]


def test_query_rows(texts, table, library):
    docs = texts(ODD).unionByName(table("documents").limit(40).selectExpr("doc_id + 1000 as doc_id", "text"), allowMissingColumns=True)
    rows = bpe.encode_digests(docs, PATH, most=500).collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = library.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_round_trip_of_ids(texts):
    docs = texts([(1, "The cat, sat."), (2, None), (3, "")])
    coded = bpe.encode(docs, PATH)
    again = {r["doc_id"]: r["text"] for r in bpe.decode(coded, PATH).collect()}
    assert again == {1: "the</w> cat</w> ,</w> sat</w> .</w>", 2: "", 3: ""}


def test_empty_table(texts):
    assert bpe.encode_digests(texts(ODD).where("false"), PATH).count() == 0


def test_frequent_words_keeps_to_its_bound(spark):
    counts = spark.createDataFrame([(f"w{i}", 2 ** (i // 4)) for i in range(40)], "word string, n bigint")
    assert set(bpe.frequent_words(counts, 10)) == {f"w{i}" for i in range(32, 40)}
    assert bpe.frequent_words(counts, 3) == [] and len(bpe.frequent_words(counts, 40)) == 40


def test_lexicon_is_exact_and_shares_suffixes():
    words = {f"{a}{b}ing".encode(): [i, j] for i, a in enumerate("abcdef") for j, b in enumerate("uvwxyz")} | {b"": [9], b"a": [1], b"auing": [7]}
    lexicon = Lexicon(compile_lexicon({w: i for w, i in words.items() if w}))
    known = [w for w in words if w]
    assert lexicon.find(known) == [words[w] for w in known]
    assert lexicon.find([b"", b"au", b"auingx", b"zzz", b"\xff"]) == [None] * 5
    assert len(lexicon.final) < 12  # a trie would have over 150 states


def test_a_chunk_in_memory_is_held_once():
    rules, draw = bpe.rules_of(PATH), random.Random(4)
    assert bpe.rules_of(PATH) is rules  # a worker's tasks share the file's tables
    encoder = bpe.Encoder(rules, compile_lexicon({}))
    words = ["".join(draw.choices("abcdefghij", k=8)) for _ in range(5_000)]
    encoder.digests([" ".join(words)])
    assert len(encoder.known) == len(set(words))
    assert sum(len(v) for k, v in vars(encoder).items() if isinstance(v, dict)) == len(set(words))


def test_workers_give_freed_memory_back(texts):
    bpe.encode_digests(texts([(1, "a b")]), PATH).collect()
    held = texts([(1, "a")]).sparkSession.sparkContext.environment
    assert held["ARROW_DEFAULT_MEMORY_POOL"] == "system" and int(held["MALLOC_TRIM_THRESHOLD_"]) <= 16 << 20


def test_the_driver_holds_no_vocabulary_and_no_object_per_word(texts):
    draw = random.Random(3)
    words = sorted({"".join(draw.choices("abcdefgh\xe9", k=7)) for _ in range(3_000)})
    docs = texts([(i, " ".join(words[i::40]) + " <|endoftext|>") for i in range(40)])
    tracemalloc.start()
    try:
        block = bpe.lexicon_of(docs, PATH)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    rules = bpe.WordBpe(PATH)
    assert block == compile_lexicon({w.encode(): rules.merge(w.encode()) for w in words})
    assert peak < 8e6  # the file's tables alone take more
