import json
import random
import time
from hashlib import sha256

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe
from millrace.llm.bpe import Encoder, Pairs, Vocabulary, decoded, encoded, op12_bpe_backtrack, vocabulary_text
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def text():
    return vocabulary_text()


@pytest.fixture(scope="module")
def library(text):
    return Tokenizer.from_str(text)


def ids(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("folder", ["odd", SF])
def test_query_equals_library(spark, request, read, same, library, folder):
    folder = folder if "/" in folder else request.getfixturevalue(folder)
    docs = read(folder)
    digest = lambda s: sha256(s.encode()).hexdigest()
    want = [(d["doc_id"], len(i), digest(" ".join(map(str, i))), digest(library.decode(i, skip_special_tokens=False)))
            for d, i in zip(docs, ids(library, [d["text"] or "" for d in docs]))]
    same([tuple(r) for r in op12_bpe_backtrack(spark, folder).collect()], want)


def random_texts():
    rng = random.Random(7)
    out = ["<|endoftext|>a<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "a\x1cb \x1f x\x85y\xa0z ́q", "ΑΣ İ é ՘a", "x" * 5001]
    for letters in ("an", "abcdeinotrs", "the", "0123 .,-'\"s"):
        out += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    spans = ((32, 127), (128, 0x250), (0x300, 0x3000), (0x3000, 0xD800), (0xE000, 0x110000))
    out += ["".join(chr(rng.randrange(*rng.choice(spans))) for _ in range(rng.randrange(1, 40))) for _ in range(1500)]
    return out


def test_words_of_all_kinds(text, library):
    remembered, table = bpe.built(text)
    texts = random_texts()
    found, edges = remembered(texts)
    assert [found[a:b].tolist() for a, b in zip(edges, edges[1:])] == ids(library, texts)
    assert table.texts(found.astype("int64"), edges).to_pylist() == [library.decode(i, skip_special_tokens=False) for i in ids(library, texts)]


def merged(symbols, rank):
    """Plain merging: the pair of the lowest rank, the leftmost first."""
    symbols = list(symbols)
    while True:
        best = min(((rank[a, b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (a, b) in rank), default=None)
        if best is None:
            return symbols
        symbols[best[1]:best[1] + 2] = [symbols[best[1]] + symbols[best[1] + 1]]


def small_file(merges):
    """A vocabulary of the same kind with merges of its own."""
    file = json.loads(vocabulary_text())
    base = [n for n, i in file["model"]["vocab"].items() if i < 512]
    file["model"]["vocab"] = {n: i for i, n in enumerate([*base, *(a + b for a, b in merges)])}
    file["model"]["merges"] = [list(m) for m in merges]
    file["added_tokens"] = []
    return json.dumps(file)


@pytest.mark.parametrize("seed", range(6))
def test_any_order_of_merges(seed):
    """Merges dealt at random, with tokens that their own bytes are not merged to."""
    rng, names, merges = random.Random(seed), ["a", "b", "c"], []
    while len(merges) < 25:
        a, b = rng.choice(names), rng.choice(names)
        if a + b not in names:
            merges.append((a, b))
            names.append(a + b)
    encode = Encoder(vocabulary := Vocabulary(small_file(merges)))
    rank = {m: i for i, m in enumerate(merges)}
    for _ in range(400):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 25)))
        want = merged([*word[:-1], word[-1] + "</w>"], rank)
        assert [vocabulary.names[t] for t in encode(word)] == want


def test_pairs_are_those_that_merging_leaves(text):
    vocabulary = Vocabulary(text)
    pairs, rng = Pairs(vocabulary), random.Random(1)
    rank = {(vocabulary.symbols[a], vocabulary.symbols[b]): r for (a, b), (r, _) in vocabulary.merged.items()}
    inner = [t for t, s in vocabulary.symbols.items() if s.isascii() and s.isalpha()]
    answers = []
    for _ in range(3000):
        a, b = rng.choice(inner), rng.choice(inner[:800])
        left, right = vocabulary.symbols[a], vocabulary.symbols[b]
        answers.append(pairs(a, b))
        assert answers[-1] == (merged(left + right, rank) == [left, right])
    assert 100 < sum(answers) < 2900


def test_time_is_linear_in_a_word(text):
    encode = bpe.built(text)[0].encode

    def seconds(n):
        started = time.perf_counter()
        encode("ab" * n + "z")
        return time.perf_counter() - started

    seconds(1000)
    assert seconds(200_000) < 40 * max(seconds(10_000), 0.01)


def test_rows_are_kept_and_come_back(spark, text):
    docs = spark.createDataFrame([(1, "Hello world", "i", "r"), (1, None, None, "r"), (None, "", "i", None)],
                                 "doc_id long, text string, ids string, row string")
    out = decoded(encoded(docs, text), text)
    assert [(tuple(r["row"]), r["ids"], r["text"]) for r in out.collect()] == [
        ((1, "Hello world", "i", "r"), [3306, 1002], "hello</w> world</w>"), ((1, None, None, "r"), [], ""), ((None, "", "i", None), [], "")]


def test_long_text_is_encoded_whole(spark, text, library):
    long = "word and another, " * 60_000
    out = encoded(spark.createDataFrame([(1, long)], "doc_id long, text string"), text, ["doc_id"]).collect()
    assert out[0]["ids"] == library.encode(long, add_special_tokens=False).ids


def test_empty_table_and_other_files(spark, bare):
    assert op12_bpe_backtrack(spark, bare).count() == 0
    with pytest.raises(ValueError):
        vocabulary_text(public_tokenizers.path("byte_bpe_50k.json"))
