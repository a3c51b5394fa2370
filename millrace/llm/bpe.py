"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

Merging pairs again and again takes a word's length times its merges. Here the word is read once by an Aho-Corasick
automaton of all tokens, which gives the longest token that starts at each place. From left to right the encoder
takes the longest token that is compatible with the one before, else the next shorter one, and where none is left it takes
the last token back; a place it once left in this way is never entered again, so the time is linear. Two tokens are
compatible if merging the bytes of both gives just these two: no pair across their border has a merge that comes
before the merges which close the border. Answers are kept in a table of pairs. A sequence whose neighbours
are all compatible is the one that the merges give.

Decoding is a table of the tokens' bytes with an offset for each id, from which the bytes of all ids of a block are gathered
at once.

The vocabulary is a file of the ``tokenizers`` library: byte-level pieces with a suffix at word ends, cut by a pattern
that never takes white space, with special tokens, no post-processor and no decoder; a file of another kind is
refused. The file is read once, on the driver, and sent to the tasks (under 2 MB). Runs without white space are lowered
and cut by its pattern; those that are not in normal form, or have characters that Python reads otherwise (of other Unicode
versions), by the file's own normaliser and cutter. A task remembers the ids of a bounded number of runs and words.

Defined results: null and empty texts have no ids and decode to an empty text. Special tokens written out in a text are
their ids. Repeated rows are encoded each for itself. Texts are encoded whole; one of any length takes linear time, and
memory for its words and ids. Empty tables give no rows. Other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from millrace.llm.tables import documents, in_batches

VOCABULARY = "word_bpe_49k.json"
#: Added to the last byte of a word, which is a symbol of its own.
LAST = 256
#: Different words, or pairs of tokens, that a task remembers at a time; of runs half as many.
REMEMBERED = 1 << 18


def byte_of_character() -> dict[str, int]:
    """Byte-level files write a byte as itself where that is a visible character, the others as those from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in visible)
    return {**{chr(b): b for b in visible}, **{chr(256 + n): b for n, b in enumerate(hidden)}}


class Vocabulary:
    """Tokens, merges and special tokens of a file, as plain tables."""

    def __init__(self, text: str):
        self.text = text
        file = json.loads(text)
        model, cutter = file["model"], file["pre_tokenizer"]
        known = (model["type"] == "BPE" and file["post_processor"] is None and file["decoder"] is None
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
                 and model["end_of_word_suffix"] and [p["type"] for p in cutter["pretokenizers"]] == ["Split", "ByteLevel"]
                 and [n["type"] for n in file["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
                 and not any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in file["added_tokens"]))
        if not known:
            raise ValueError("not a byte-pair vocabulary with word ends, special tokens only, and no decoder")
        if any(regex.search(r"\s", word) for word in regex.findall(cutter["pretokenizers"][0]["pattern"]["Regex"], "a b 1 2\n! '\t'")):
            raise ValueError("words of this vocabulary hold white space")
        self.suffix = model["end_of_word_suffix"]
        self.pattern = cutter["pretokenizers"][0]["pattern"]["Regex"]
        self.special = {a["content"]: a["id"] for a in file["added_tokens"]}
        ids = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merged = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)}
        self.parts = {token: (pair, rank) for pair, (rank, token) in self.merged.items()}
        self.names = [""] * (1 + max(*ids.values(), *self.special.values()))
        for name, token in {**ids, **self.special}.items():
            self.names[token] = name
        # every token as a string of symbols: bytes, the last of a word from LAST on
        byte = byte_of_character()
        self.symbols: dict[int, str] = {}
        for name, token in ids.items():
            if token not in self.parts and name not in self.special:
                ends = len(name) > 1 and name.endswith(self.suffix)
                self.symbols[token] = chr(byte[name.removesuffix(self.suffix) if ends else name] + LAST * ends)
        for rank, (a, b) in enumerate(merges):
            left, right = ids[a], ids[b]
            if left not in self.symbols or right not in self.symbols:
                raise ValueError(f"merge {rank} comes before its parts")
            self.symbols[ids[a + b]] = self.symbols[left] + self.symbols[right]


class Pairs:
    """Which token may stand before which."""

    def __init__(self, vocabulary: Vocabulary):
        self.merged, self.parts, self.known = vocabulary.merged, vocabulary.parts, {}

    def border(self, token: int, side: int, never: float) -> list[tuple[int, float]]:
        """The tokens that lie at one end of a token while it is made, and the rank at which each is merged."""
        out, until = [(token, never)], never
        while token in self.parts:
            pair, until = self.parts[token]
            token = pair[side]
            out.append((token, until))
        return out

    def joined_before(self, left: int, right: int, rank: float) -> bool:
        """Whether merging the bytes of both, up to a rank, joins something across their border.

        Equal pairs are merged from the left on: what ends at the border goes first, what starts there does not.
        """
        others = self.border(right, 0, rank)
        for a, a_until in self.border(left, 1, rank):
            for b, b_until in others:
                merge = self.merged.get((a, b))
                if merge and merge[0] < min(rank, a_until) and merge[0] <= b_until:
                    return True
        return False

    def __call__(self, left: int, right: int) -> bool:
        answer = self.known.get((left, right))
        if answer is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            answer = self.known[left, right] = not self.joined_before(left, right, float("inf"))
        return answer


class Encoder:
    """Words to ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.pairs = Pairs(vocabulary)
        # a token that its own bytes are not merged to never comes out
        made: dict[int, bool] = {}
        for token in vocabulary.symbols:
            if token not in vocabulary.parts:
                made[token] = True
        for token, ((left, right), rank) in sorted(vocabulary.parts.items(), key=lambda t: t[1][1]):
            made[token] = made[left] and made[right] and not self.pairs.joined_before(left, right, rank)
        self.tokens = tokens = {vocabulary.symbols[t]: t for t, own in made.items() if own}
        self.length = [0] * len(vocabulary.names)
        #: The longest token that a token begins with; -1 for a symbol.
        self.shorter = [-1] * len(vocabulary.names)
        for symbols, token in tokens.items():
            self.length[token] = len(symbols)
            self.shorter[token] = next((tokens[symbols[:n]] for n in range(len(symbols) - 1, 0, -1) if symbols[:n] in tokens), -1)
        # read backwards, the longest match that ends at a place is the longest token that starts there
        self.automaton = ahocorasick.Automaton()
        for symbols, token in tokens.items():
            self.automaton.add_word(symbols[::-1], token)
        self.automaton.make_automaton()

    def longest(self, symbols: str) -> list[int]:
        """For each place the longest token that starts there; every symbol is a token, so there is one."""
        # matches with the same end come from the longest to the shortest
        found = [*self.automaton.iter(symbols[::-1])]
        found.reverse()
        return [*dict(found).values()]

    def __call__(self, word: str) -> list[int]:
        raw = word.encode().decode("latin-1")
        symbols = raw[:-1] + chr(ord(raw[-1]) + LAST)
        whole = self.tokens.get(symbols)
        if whole is not None:
            return [whole]
        longest, length, shorter, known = self.longest(symbols), self.length, self.shorter, self.pairs.known
        n, at, token, before = len(symbols), 0, longest[0], -1
        out: list[int] = []
        left = bytearray(n + 1)
        while at < n:
            while token >= 0:
                end = at + length[token]
                if not left[end]:
                    fits = known.get((before, token)) if before >= 0 else True
                    if fits is None:
                        fits = self.pairs(before, token)
                    if fits:
                        break
                token = shorter[token]
            if token < 0:
                left[at] = 1
                token = out.pop()
                at -= length[token]
                token, before = shorter[token], out[-1] if out else -1
            else:
                out.append(token)
                before, at = token, end
                token = longest[at] if at < n else -1
        return out


class Cutter:
    """Texts to runs without white space, and those to words, as the file says.

    No word reaches over white space, and nothing the normaliser does depends on what lies beyond it.
    """

    def __init__(self, vocabulary: Vocabulary):
        file = Tokenizer.from_str(vocabulary.text)
        self.normalised, self.own_cut = file.normalizer.normalize_str, file.pre_tokenizer.pre_tokenize_str
        self.pattern = regex.compile(vocabulary.pattern)
        self.special = vocabulary.special
        names = sorted(self.special, key=len, reverse=True)
        self.any_special = re.compile("(" + "|".join(map(re.escape, names)) + ")")
        self.agreed: dict[str, bool] = {}

    def agrees(self, character: str) -> bool:
        """Whether Python reads a character as the file's own normaliser and cutter do, as seen from words with it."""
        known = self.agreed.get(character)
        if known is None:
            probe = f"a{character}1{character}!{character}{character}"
            lower = unicodedata.normalize("NFC", probe).lower()
            known = self.agreed[character] = (
                unicodedata.category(character) != "Cn" and self.normalised(probe) == lower and self.library_words(lower) == self.pattern.findall(lower))
        return known

    def library_words(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.own_cut(text)]

    def words(self, run: str) -> list[str]:
        # no two characters that Python knows and that are normalised already are joined by other Unicode versions
        if run.isascii() or (all(map(self.agrees, set(run))) and unicodedata.is_normalized("NFC", run)):
            return self.pattern.findall(run.lower())
        return self.library_words(self.normalised(run))

    def runs(self, text: str) -> list[str | int]:
        """Runs without white space, and the ids of special tokens, in order."""
        if not any(name in text for name in self.special):
            return unspaced(text)
        out: list[str | int] = []
        for n, piece in enumerate(self.any_special.split(text)):
            out += [self.special[piece]] if n % 2 else unspaced(piece)
        return out


def unspaced(text: str) -> list[str]:
    return SPACES.split(text) if SEPARATORS.search(text) else text.split()


SPACES = regex.compile(r"\s+")
#: White space for ``str.split``, but not for patterns.
SEPARATORS = re.compile("[\x1c-\x1f]")


class Remembered(dict):
    """The number of each run that was met, and the ids of all runs by number; words are remembered as well."""

    def __init__(self, cutter: Cutter, encode: Callable[[str], list[int]]):
        self.cutter, self.encode = cutter, encode
        self.known: dict[str, array] = {}
        self.size = 0
        self.forget()

    def forget(self) -> None:
        if len(self.known) > REMEMBERED or self.size > REMEMBERED * 16:
            self.known.clear()
        self.clear()
        self.ids, self.counts, self.size = array("i"), array("i"), 0

    def __missing__(self, run: str | int) -> int:
        before = len(self.ids)
        if isinstance(run, int):
            self.ids.append(run)
        else:
            self.size += len(run)
            for word in self.cutter.words(run):
                found = self.known.get(word)
                if found is None:
                    found = self.known[word] = array("i", self.encode(word))
                self.ids.extend(found)
        self.counts.append(len(self.ids) - before)
        number = self[run] = len(self.counts) - 1
        return number

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin."""
        if max(2 * len(self), len(self.known)) > REMEMBERED or self.size > REMEMBERED * 16:
            self.forget()
        numbers = [np.fromiter(map(self.__getitem__, runs), np.int64, len(runs)) for runs in (self.cutter.runs(t or "") for t in texts)]
        number = np.concatenate([np.zeros(0, np.int64), *numbers])
        counts = np.array(self.counts, np.int64)
        first, lengths = np.cumsum(counts) - counts, counts[number]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(first[number] - ends[:-1], lengths) + np.arange(ends[-1])
        return np.array(self.ids, np.int32)[at], ends[np.cumsum([0, *map(len, numbers)])]


class Table:
    """Bytes of all tokens one behind the other, and the offset of each; a space stands before each token."""

    def __init__(self, names: list[str]):
        raw = [b" " + n.encode() for n in names]
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.offsets = np.cumsum([0, *map(len, raw)])

    def texts(self, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        """One text for each run of ids between two edges: its tokens with a space between."""
        starts, lengths = self.offsets[ids], np.diff(self.offsets)[ids]
        begins = edges[:-1][np.diff(edges) > 0]
        starts[begins] += 1
        lengths[begins] -= 1
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])
        return pa.StringArray.from_buffers(
            len(edges) - 1, pa.py_buffer(ends[edges].astype(np.int32)), pa.py_buffer(self.bytes[at]))


#: What the Python worker has built, by the text of the file.
_BUILT: dict[str, tuple[Remembered, Table]] = {}


def built(text: str) -> tuple[Remembered, Table]:
    if text not in _BUILT:
        vocabulary = Vocabulary(text)
        _BUILT[text] = Remembered(Cutter(vocabulary), Encoder(vocabulary)), Table(vocabulary.names)
    return _BUILT[text]


def vocabulary_text(path: str | None = None) -> str:
    """The file, read on the driver; what it does not know how to encode is refused here."""
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        text = file.read()
    Vocabulary(text)
    return text


def encoded(docs: DataFrame, vocabulary: str, keep: list[str] | None = None) -> DataFrame:
    """``row`` with the columns to keep (all unless named), and ``ids`` of the column ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    row = F.struct(*(F.col(f"`{c}`") for c in keep or docs.columns))
    frame = docs.select(row.alias("row"), F.col("text").alias("text"))

    def run(batches):
        remembered, _ = built(sent.value)
        for batch in batches:
            ids, edges = remembered(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids))], names=["row", "ids"])

    return in_batches(frame, run, f"row {frame.schema['row'].dataType.simpleString()}, ids array<int>")


def decoded(frame: DataFrame, vocabulary: str) -> DataFrame:
    """A frame of ``row`` and ``ids`` with the decoded ``text``; null ids decode to an empty text."""
    sent = frame.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        _, names = built(sent.value)
        for batch in batches:
            column = batch.column(1)
            lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
            ids = np.asarray(column.flatten().cast(pa.int64()))
            text = names.texts(ids, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), column, text], names=["row", "ids", "text"])

    row = frame.schema["row"].dataType.simpleString()
    return in_batches(frame.select("row", "ids"), run, f"row {row}, ids array<int>, text string")


def op12_bpe_backtrack(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = vocabulary_text()
    out = decoded(encoded(documents(spark, folder), vocabulary, ["doc_id"]), vocabulary)
    return out.select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
