"""Byte-level BPE encoding and decoding: speculate, verify, merge what fails.

A text is split at special tokens and then by the pattern of byte-level
tokenizers into words. For each distinct word the longest token at every byte is
looked up in a trie, and the greedy sequence of longest tokens is the guess. Merges
are undone from the top to see which tokens stand on both sides of a border at any
time: the guess is what the merges give exactly if no two tokens that ever meet at a
border of it would have been merged. All borders of a block of words are tested
together, a step of undoing at a time. Only words with a border that fails go
through the merges themselves.

The proof needs tokens that the merges give for their own bytes (others are not
guessed) and merges of parts that are bytes or made by earlier merges; a file whose
merges are in another order is refused, as are files with parts that this module
does not know (normalizers, other pre-tokenizers, stripping special tokens).

Memory follows a block of `BLOCK_CHARS` and the longest run of characters without a
break, not the text. A task keeps the ids of `KEPT_WORDS` words at most.

Defined results: null and empty texts have no ids, and are decoded to an empty text;
repeated rows are encoded each; an id without a token decodes to nothing; bytes that
are not UTF-8 decode to U+FFFD; an empty table gives no rows; further columns stay as
they are, but for a column with the name of the result, which is replaced.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from .common import documents, free_names

VOCABULARY = "byte_bpe_50k.json"
# Fixed value: how byte-level tokenizers split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_CHARS = 1 << 20
SLICE = 1 << 18  # positions at which the longest token is looked up together
KEPT_WORDS = 1 << 18
KEPT_BYTES = 64
NO_MERGE = 1 << 40

Batches = Iterator[pa.RecordBatch]
_BREAK = regex.compile(r"(?<=\S)\s")


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def merged(
    parts: list[int], ranks: dict[tuple[int, int], tuple[int, int]]
) -> tuple[list[int], int]:
    """The tokens of a word by the merges, and the rank of the last merge: always the
    earliest merge that is possible, the leftmost of equal ones. `ranks` gives
    (rank, token) of a pair."""
    n, last = len(parts), -1
    parts = list(parts)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [
        (*found, i, parts[i], parts[i + 1])
        for i in range(n - 1)
        if (found := ranks.get((parts[i], parts[i + 1])))
    ]
    heapq.heapify(heap)
    while heap:
        rank, token, i, a, b = heapq.heappop(heap)
        j = right[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue  # one of the two is part of another token by now
        parts[i], parts[j], last = token, -1, rank
        right[i] = after = right[j]
        if after < n:
            left[after] = i
            if found := ranks.get((token, parts[after])):
                heapq.heappush(heap, (*found, i, token, parts[after]))
        before = left[i]
        if before >= 0 and (found := ranks.get((parts[before], token))):
            heapq.heappush(heap, (*found, before, parts[before], token))
    return [p for p in parts if p >= 0], last


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is in a sorted table, and whether it is there at all."""
    at = np.searchsorted(table, keys)
    if not len(table):
        return at, np.zeros(len(keys), dtype=bool)
    at[at == len(table)] = 0
    return at, table[at] == keys


class Vocabulary:
    """The tables of a tokenizer file; their size is that of the vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, split = file["model"], file["pre_tokenizer"] or {}
        added = file["added_tokens"]
        if (
            model["type"] != "BPE"
            or file["normalizer"]
            or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space")
            or not split.get("use_regex", True)
            or (file["decoder"] or {}).get("type") != "ByteLevel"
            or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
            or any(model.get(k) for k in ("dropout", "unk_token", "ignore_merges"))
            or any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        self.special = {t["content"]: t["id"] for t in added}
        byte = byte_characters()
        vocab = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items()}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.text = [b""] * self.size
        for t, i in [*vocab.items(), *((t.encode(), i) for t, i in self.special.items())]:
            self.text[i] = t
        self.of_byte = np.array([vocab[bytes([b])] for b in range(256)])
        self._merges(model["merges"], byte, vocab)
        self._trie()

    def _merges(self, merges: list, byte: dict[str, int], vocab: dict[bytes, int]) -> None:
        """Of each token that the merges give for its own bytes: its last merge, and
        that merge's parts. Bytes have rank -1, tokens that are not given -2."""
        made = set(self.of_byte.tolist())
        parts = []
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            both = pair.split(" ") if isinstance(pair, str) else pair
            a, b = (vocab[bytes(byte[c] for c in part)] for part in both)
            if a not in made or b not in made:
                raise ValueError(f"merge {rank} needs a token of a later merge")
            token = vocab[self.text[a] + self.text[b]]
            made.add(token)
            parts.append((a, b))
            self.ranks.setdefault((a, b), (rank, token))
        self.rank = np.full(self.size, -2)
        self.left, self.right = np.zeros((2, self.size), dtype=np.int64)
        self.rank[self.of_byte] = -1
        for token in made - set(self.of_byte.tolist()):
            given, last = merged([int(self.of_byte[x]) for x in self.text[token]], self.ranks)
            if given == [token]:
                self.rank[token] = last
                self.left[token], self.right[token] = parts[last]
        key = np.array([a * self.size + b for a, b in self.ranks], dtype=np.int64)
        order = np.argsort(key)
        self.pair = key[order]
        self.pair_rank = np.array([r for r, _ in self.ranks.values()], dtype=np.int64)[order]
        self.made = np.zeros(len(merges), dtype=np.int64)
        self.made[[r for r, _ in self.ranks.values()]] = [t for _, t in self.ranks.values()]

    def _trie(self) -> None:
        """Nodes of the trie of the tokens that may be guessed: the node behind a
        node and a byte, and the token that ends at a node (-1: none). The node of a
        single byte is the byte's number."""
        step: dict[int, int] = {}
        ends = {b: int(self.of_byte[b]) for b in range(256)}
        nodes = 256
        for token in np.flatnonzero(self.rank >= 0).tolist():
            node = self.text[token][0]
            for b in self.text[token][1:]:
                key = node * 256 + b
                node = step.get(key, nodes)
                if node == nodes:
                    step[key] = node
                    nodes += 1
            ends[node] = token
        key = np.array(list(step), dtype=np.int64)
        order = np.argsort(key)
        self.step, self.next = key[order], np.array(list(step.values()), np.int64)[order]
        self.ends = np.full(nodes, -1)
        self.ends[list(ends)] = list(ends.values())

    def longest(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token that begins at each byte, and its length. `ends` are the
        ends of the words, which are all of `raw`."""
        token = self.of_byte[raw].astype(np.int32)
        size = np.ones(len(raw), dtype=np.int32)
        for first in range(0, len(raw), SLICE):
            at = np.arange(first, min(len(raw), first + SLICE))
            node = raw[at].astype(np.int64)
            end = ends[np.searchsorted(ends, at, side="right")]
            for length in range(2, len(raw) + 1):
                on = at + length <= end
                at, node, end = at[on], node[on], end[on]
                place, found = _found(self.step, node * 256 + raw[at + length - 1])
                at, node, end = at[found], self.next[place[found]], end[found]
                if not len(at):
                    break
                own = self.ends[node]
                whole = own >= 0
                token[at[whole]] = own[whole]
                size[at[whole]] = length
        return token, size

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Do the merges leave the token a before the token b as these two?

        The last merge of the two tokens is undone again and again. Before it came a
        state with other tokens at the border; had these a merge of lower rank than
        the one undone, that would have come first. Of equal ranks the leftmost comes
        first, so the right token's merge is undone first and also an equal rank of
        the pair at the border comes before it."""
        good = np.ones(len(a), dtype=bool)
        row = np.arange(len(a))
        limit = np.full(len(a), len(self.pair) + 1)
        while len(row):
            at, found = _found(self.pair, a * self.size + b)
            bad = found.copy()
            bad[found] = self.pair_rank[at[found]] < limit[found]
            good[row[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = ~bad & (np.maximum(ra, rb) >= 0)
            row, a, b, ra, rb = row[on], a[on], b[on], ra[on], rb[on]
            of_a = ra > rb
            a, b = np.where(of_a, self.right[a], a), np.where(of_a, b, self.left[b])
            limit = np.where(of_a, ra, rb + 1)
        return good

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of up to KEPT_BYTES by the merges, one merge of every word
        at a time."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        token = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        number = np.arange(len(words))  # of the words that still have a merge

        def ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            at, found = _found(self.pair, a * self.size + b)
            return np.where(found, self.pair_rank[at], NO_MERGE)

        rank = np.append(ranks(token[:-1], token[1:]), NO_MERGE)
        rank[np.cumsum(sizes) - 1] = NO_MERGE
        while len(number):
            start = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank, start)
            done = least == NO_MERGE
            if done.any():
                ids = token.astype("<u4").tobytes()
                for i in np.flatnonzero(done).tolist():
                    out[number[i]] = ids[4 * start[i] : 4 * (start[i] + sizes[i])]
                on = np.repeat(~done, sizes)
                token, rank = token[on], rank[on]
                number, sizes, least = number[~done], sizes[~done], least[~done]
                if not len(number):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            word = np.searchsorted(np.cumsum(sizes), at, side="right")
            at = at[np.append(True, word[1:] != word[:-1])]
            token[at] = self.made[least]
            token, rank = np.delete(token, at + 1), np.delete(rank, at + 1)
            sizes = sizes - 1
            at = at - np.arange(len(at))
            ends = np.cumsum(sizes)
            before, behind = at[at > ends - sizes], at[at < ends - 1]
            rank[ends - 1] = NO_MERGE
            rank[behind] = ranks(token[behind], token[behind + 1])
            rank[before - 1] = ranks(token[before - 1], token[before])
        return out

    def encode_words(self, words: list[bytes]) -> tuple[list[bytes], int]:
        """The ids of each word (little-endian, 32 bits each), none empty, and how many
        words went through the merges."""
        if not words:
            return [], 0
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        starts = np.append(0, ends[:-1])
        token, size = self.longest(raw, ends)
        begins = np.zeros(len(raw), dtype=bool)
        at, end = starts, ends
        while len(at):
            begins[at] = True
            at = at + size[at]
            on = at < end
            at, end = at[on], end[on]
        place = np.flatnonzero(begins)
        guess = token[place].astype(np.int64)
        word = np.searchsorted(ends, place, side="right")
        border = np.flatnonzero(word[1:] == word[:-1])
        kinds, kind = np.unique(guess[border] * self.size + guess[border + 1], return_inverse=True)
        fails = ~self.compatible(kinds // self.size, kinds % self.size)[kind]
        failing = np.unique(word[border[fails]]).tolist()
        ids = guess.astype("<u4").tobytes()
        cuts = (4 * np.append(0, np.cumsum(np.bincount(word, minlength=len(words))))).tolist()
        found = [ids[x:y] for x, y in itertools.pairwise(cuts)]
        short = [i for i in failing if len(words[i]) <= KEPT_BYTES]
        for i, exact in zip(short, self.merge_words([words[i] for i in short]), strict=True):
            found[i] = exact
        for i in set(failing) - set(short):
            exact, _ = merged(self.of_byte[list(words[i])].tolist(), self.ranks)
            found[i] = np.array(exact, dtype="<u4").tobytes()
        return found, len(failing)


def newer_letters() -> str:
    """The letters and numbers of the regex library's Unicode version that are neither
    in the tokenizers library's, as ranges for a character class. Only code points on
    which regex and Python differ are asked for."""
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    kinds = {c: "L" for c in regex.findall(r"\p{L}", every)}
    kinds |= {c: "N" for c in regex.findall(r"\p{N}", every)}
    split = pre_tokenizers.ByteLevel(add_prefix_space=False)
    newer = [
        ord(c)
        for c, kind in kinds.items()
        if unicodedata.category(c)[0] != kind and len(split.pre_tokenize_str("!" + c)) == 1
    ]
    runs: list[list[int]] = []
    for c in sorted(newer):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in runs)


class Splitter:
    """Splits a text into words as byte-level tokenizers do."""

    def __init__(self):
        self.plain = regex.compile(PATTERN)
        newer = newer_letters()
        if newer:
            mark = rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])"
            older = PATTERN.replace(r"[^\s\p{L}\p{N}]", mark)
            for kind in "LN":
                older = older.replace(rf" ?\p{{{kind}}}", rf" ?[\p{{{kind}}}--[{newer}]]")
            self.older = regex.compile("(?V1)" + older)
            self.newer = re.compile(f"[{newer}]")
        else:
            self.older, self.newer = self.plain, re.compile("(?!)")

    def words(self, text: str) -> list[str]:
        if not text.isascii() and self.newer.search(text):
            return self.older.findall(text)
        return self.plain.findall(text)


class Encoder:
    """Encodes texts block by block and keeps the ids of short words."""

    def __init__(self, vocabulary: Vocabulary, splitter: Splitter | None = None):
        self.vocabulary = vocabulary
        self.kept: dict[str, bytes] = {}
        self.words = (splitter or Splitter()).words
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def _pieces(self, text: str) -> Iterator[tuple[str, bytes]]:
        """Parts of a text that are encoded by themselves, each with the ids of the
        special token behind it. Long ones end before a blank that follows another
        character, where no word goes on."""
        first = 0
        for found in self.special.finditer(text) if self.special else ():
            yield from ((x, b"") for x in self._blocks(text[first : found.start()]))
            yield "", np.array([self.vocabulary.special[found[0]]], dtype="<u4").tobytes()
            first = found.end()
        yield from ((x, b"") for x in self._blocks(text[first:] if first else text))

    def _blocks(self, text: str) -> Iterator[str]:
        first = 0
        while len(text) - first > BLOCK_CHARS:
            found = _BREAK.search(text, first + BLOCK_CHARS)
            if not found:
                break
            yield text[first : found.start()]
            first = found.start()
        yield text[first:] if first else text

    def _ids(self, pieces: list[list[str]]) -> list[bytes]:
        """The ids of each list of words."""
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        new = list(set().union(*pieces) - self.kept.keys())
        ids, _ = self.vocabulary.encode_words([w.encode() for w in new])
        known = self.kept
        long = {w: i for w, i in zip(new, ids, strict=True) if len(w) > KEPT_BYTES}
        known.update((w, i) for w, i in zip(new, ids, strict=True) if len(w) <= KEPT_BYTES)
        if not long:
            return [b"".join([known[w] for w in words]) for words in pieces]
        either = lambda w: long[w] if w in long else known[w]
        return [b"".join(map(either, words)) for words in pieces]

    def blocks(self, texts: Iterable[str | None]) -> Iterator[list[bytes]]:
        """The ids of each text, some texts at a time."""
        out: list[list[bytes]] = []  # finished parts of each text of the block
        held: list[list[str]] = []
        owner: list[int] = []
        chars = 0

        def encoded() -> None:
            for i, ids in zip(owner, self._ids(held), strict=True):
                out[i].append(ids)
            held.clear()
            owner.clear()

        for text in texts:
            out.append([])
            for piece, special in self._pieces(text or ""):
                if piece:
                    held.append(self.words(piece))
                    owner.append(len(out) - 1)
                    chars += len(piece)
                if special:
                    # Its place is behind what is held of this text.
                    held.append([])
                    owner.append(len(out) - 1)
                    encoded()
                    out[-1].append(special)
                if chars > BLOCK_CHARS:
                    encoded()
                    chars = 0
                    if len(out) > 1:
                        yield [b"".join(x) for x in out[:-1]]
                        out = out[-1:]
        encoded()
        if out:
            yield [b"".join(x) for x in out]


def _with(docs: DataFrame, name: str, kind: str) -> tuple[list[str], T.StructType]:
    """The other columns of `docs`, and a schema with `name` behind them."""
    others = [f for f in docs.schema.fields if f.name.lower() != name.lower()]
    added = T.StructField(name, T._parse_datatype_string(kind))
    return [f.name for f in others], T.StructType([*others, added])


def decoded_text(table: list[bytes], ids: bytes) -> str:
    """The text of ids; `table` has the bytes of each token."""
    n = len(table)
    found = np.frombuffer(ids, "<u4").tolist()
    return b"".join([table[i] if i < n else b"" for i in found]).decode("utf-8", "replace")


def encode_texts(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """`docs` with the ids of `text` as little-endian unsigned 32-bit integers and, as
    `decoded`, if it is named, the text that `decode_ids` makes of them: a task then
    needs one Python worker with the tables and not two."""
    vocabulary, splitter = Vocabulary(path), Splitter()
    names, schema = _with(docs, ids, "binary")
    if decoded:
        names = [n for n in names if n.lower() != decoded.lower()]
        kept = [f for f in schema if f.name.lower() != decoded.lower()]
        schema = T.StructType([*kept, T.StructField(decoded, T.StringType())])

    def encode(batches: Batches) -> Batches:
        encoder = Encoder(vocabulary, splitter)
        for batch in batches:
            rows = batch.select(list(range(1, batch.num_columns)))
            at = 0
            for found in encoder.blocks(x.as_py() for x in batch.column(0)):
                part = rows.slice(at, len(found))
                columns = [*part.columns, pa.array(found, pa.binary())]
                if decoded:
                    texts = [decoded_text(vocabulary.text, x) for x in found]
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                at += len(found)

    of = docs[f"`{text}`"].cast("string").alias(*free_names(names, "_text"))
    return docs.select(of, *[docs[f"`{n}`"] for n in names]).mapInArrow(encode, schema)


def decode_ids(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`docs` with the text of `ids`, special tokens included."""
    table = Vocabulary(path).text
    names, schema = _with(docs, text, "string")

    def decode(batches: Batches) -> Batches:
        for batch in batches:
            found = [decoded_text(table, x.as_py() or b"") for x in batch.column(0)]
            column = pa.array(found, pa.string())
            rows = batch.columns[1:]
            yield pa.RecordBatch.from_arrays([*rows, column], schema.names)

    of = docs[f"`{ids}`"].alias(*free_names(names, "_ids"))
    return docs.select(of, *[docs[f"`{n}`"] for n in names]).mapInArrow(decode, schema)


def op12_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    # The text is not sent back: its place is taken by the ids.
    encoded = encode_texts(docs, path, ids="text", decoded="decoded")
    return encoded.select(
        "doc_id",
        (F.octet_length("text") / 4).cast("long").alias("n_tokens"),
        F.sha2("text", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
