"""BPE encoding and decoding by prefix-sharing trie traversal.

A byte pair encoding is valid exactly when each two neighbouring tokens encode to
themselves, so the encoding of a prefix is known from its last token alone: what
stands before that token is again a prefix. The distinct words of a batch, sorted,
are their trie in depth-first order; walking them keeps one last token a trie level,
and a prefix that words share is worked out once.

The merges are those of a published vocabulary file in the format of the
``tokenizers`` library (BPE with an end-of-word suffix); only the file is read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pagegraph.llm.common import Scorer, append_columns, documents, texts

#: Distinct words whose encodings a task keeps; beyond, it starts afresh.
KEPT_WORDS = 300_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> dict[str, int]:
    """The visible character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the characters from
    U+0100 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as (bytes, ends a word), and what pairs of them merge to."""

    def __init__(self, file: bytes):
        told = json.loads(file)
        model = told["model"]
        self.suffix = model["end_of_word_suffix"]
        self.strings: dict[int, str] = {i: s for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        as_byte = byte_characters()
        self.inner: dict[bytes, int] = {}
        self.last: dict[bytes, int] = {}
        self.raw: dict[int, tuple[bytes, bool]] = {}
        for string, i in model["vocab"].items():
            if string in self.special:
                continue
            ends = string.endswith(self.suffix) and len(string) > len(self.suffix)
            raw = bytes(as_byte[c] for c in (string[: -len(self.suffix)] if ends else string))
            (self.last if ends else self.inner)[raw] = i
            self.raw[i] = raw, ends
        ids = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks: dict[tuple[int, int], int] = {}
        #: Of each token, the rank of the merge that makes it (-1: none) and the two it is made of.
        self.made = {i: (-1, i, i) for i in self.strings}
        for rank, (a, b) in enumerate(pairs):
            pair = ids[a], ids[b]
            self.ranks[pair] = rank
            self.made[ids[a + b]] = rank, *pair
        self.size = {i: len(raw) for i, (raw, _) in self.raw.items()} | {-1: 0}
        self.longest = max(map(len, [*self.inner, *self.last]), default=0)
        # A token that its own bytes do not merge to is never made.
        for tokens in (self.inner, self.last):
            for raw, i in list(tokens.items()):
                if self.made[i][0] >= 0 and not self.compatible(*self.made[i][1:], self.made[i][0]):
                    del tokens[raw]

    def compatible(self, a: int, b: int, limit: float = float("inf")) -> bool:
        """Whether no merge below rank ``limit`` joins bytes of both tokens, so both stay as they are.

        Undoes the merges on the two sides of the border, the latest first: what then
        meets there must not merge earlier than what was undone. Of equal ranks the
        left one goes first.
        """
        while True:
            if self.ranks.get((a, b), limit) < limit:
                return False
            rank_a, _, right_of_a = self.made[a]
            rank_b, left_of_b, _ = self.made[b]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                limit, a = rank_a, right_of_a
            else:
                limit, b = rank_b + 1, left_of_b

    def last_token(self, word: bytes, end: int, ends: bool, states: list[int]) -> int:
        """The last token of the encoding of ``word[:end]``; ``states`` has those of shorter prefixes.

        There is exactly one, so the order of trying is free: mostly the token before,
        grown by a byte, or a shorter one.
        """
        tokens, compatible = self.last if ends else self.inner, self.compatible
        likely = min(self.size[states[end - 1]] + 1, end)
        for sizes in (range(likely, 0, -1), range(likely + 1, min(end, self.longest) + 1)):
            for size in sizes:
                token = tokens.get(word[end - size : end])
                if token is not None and (size == end or compatible(states[end - size], token)):
                    return token
        raise ValueError("the vocabulary lacks a byte")

    def encode_words(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """The tokens of each distinct word, by a depth-first walk over their trie."""
        found, states, path, size = {}, [-1], b"", self.size
        for word in sorted(words):
            shared, most = 0, min(len(word) - 1, len(path))
            if word[:most] == path[:most]:
                shared = most
            else:
                while word[shared] == path[shared]:
                    shared += 1
            del states[shared + 1 :]
            path = word[:-1]
            for end in range(shared + 1, len(word)):
                states.append(self.last_token(word, end, False, states))
            tokens, end = [self.last_token(word, len(word), True, states)], len(word)
            while (end := end - size[tokens[-1]]) > 0:
                tokens.append(states[end])
            found[word] = tokens[::-1]
        return found


#: As the vocabulary's file states it: contractions, letters, single digits, other marks.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def lowered(text: str) -> str:
    """NFC, then lower case character by character (a final sigma is like any other)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


@lru_cache(1)
def _vocabulary(file: bytes) -> Vocabulary:
    """Read once a worker process."""
    return Vocabulary(file)


class Encoder:
    """Encodes texts of a task; keeps what ``shape`` makes of the tokens of each word it has met."""

    def __init__(self, file: bytes, shape: Callable[[list[int]], object] = list):
        self.vocabulary, self.shape = _vocabulary(file), shape
        self.known: dict[str, object] = {}
        names = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token's string is one as it is."""
        if not self.special or "<|" not in text:
            return WORDS.findall(lowered(text))
        found = []
        for piece in self.special.split(text):
            found += [piece] if piece in self.vocabulary.special else WORDS.findall(lowered(piece))
        return found

    def shaped(self, batch: list[str]) -> list[list]:
        """For each text its words' shapes, in order."""
        lists = [self.words(t) for t in batch]
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        special, new = self.vocabulary.special, set().union(*lists) - self.known.keys()
        raw = {w.encode(): w for w in new if w not in special}
        self.known.update((w, self.shape([special[w]])) for w in new if w in special)
        self.known.update((raw[b], self.shape(ids)) for b, ids in self.vocabulary.encode_words(list(raw)).items())
        known = self.known
        return [[known[w] for w in words] for words in lists]

    def encode(self, batch: list[str]) -> list[list[int]]:
        return [[i for ids in words for i in ids] for words in self.shaped(batch)]

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings with a blank between, as a vocabulary without decoder gives them."""
        return " ".join(map(self.vocabulary.strings.__getitem__, ids))


def _shared(spark: SparkSession, vocabulary: str | None):
    """The vocabulary file's bytes, sent to the tasks: a published file of fixed size (2 MB)."""
    with open(vocabulary or default_vocabulary(), "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(rows: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``rows`` without the text, with ``ids`` (array of int): the tokens of the whole text.

    A null or empty text has none. Repeated rows each keep their own, other columns
    stay but one named ``ids``, which is replaced; an empty table gives an empty one.
    Long texts cost memory in proportion to one text.
    """
    file = _shared(rows.sparkSession, vocabulary)

    def scorer() -> Scorer:
        encoder = Encoder(file.value)
        return lambda column: [encoder.encode(texts(column))]

    return append_columns(rows, text_col, T.StructType().add("ids", T.ArrayType(T.IntegerType())), scorer)


def decode(rows: DataFrame, ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``rows`` without the ids, with ``decoded`` (string); null ids decode as none."""
    file = _shared(rows.sparkSession, vocabulary)

    def scorer() -> Scorer:
        encoder = Encoder(file.value)
        return lambda column: [[encoder.decode(ids or []) for ids in column.to_pylist()]]

    return append_columns(rows, ids_col, T.StructType().add("decoded", "string"), scorer)


def digests(rows: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``encode`` and ``decode`` of each text in one pass, as counts and SHA-256 digests."""
    file = _shared(rows.sparkSession, vocabulary)

    def scorer() -> Scorer:
        # Of a word: how many tokens, their ids as text, what they decode to.
        encoder = Encoder(file.value, lambda ids: (len(ids), " ".join(map(str, ids)), encoder.decode(ids)))

        def digest(parts: list[str]) -> str:
            return hashlib.sha256(" ".join(parts).encode()).hexdigest()

        def score(column: pa.Array) -> list[list]:
            told = encoder.shaped(texts(column))
            counts = [sum([n for n, _, _ in words]) for words in told]
            return [counts, [digest([ids for _, ids, _ in words]) for words in told], [digest([s for _, _, s in words]) for words in told]]

        return score

    new = T.StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return append_columns(rows, text_col, new, scorer)


def op9_bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir).select("doc_id", "text"))
