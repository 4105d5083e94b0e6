"""BPE encoding and decoding with a pair occurrence index.

The distinct words of an Arrow batch are laid out as one symbol array.  An
index maps each pair of neighbouring symbols that has a merge rank to all its
positions; the active ranks are taken in ascending order, every occurrence of
the pair is merged from left to right, and the lists of the pairs this makes
are extended.  A pair made by a merge can rank below the pair in hand; the
rest of the list then waits, so each word sees its merges in rank order.

Chunks and words found before are reused from memos that are emptied when
full (they bound memory only; results never depend on them).

The vocabulary file is a parameter (a path every executor can read); its
normaliser (NFC, white space, lower case), word pattern, byte alphabet and
word-end suffix are those of the file kind handled here, and other kinds are
refused.  Without a decoder in the file, decoding joins the tokens' strings
by spaces.

Nulls and edges: a null or empty text encodes to no ids and decodes to the
empty string; whole texts are encoded, whatever their length; ids of
documents are carried unread; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pixelflow.llm.common import map_batches

#: The word pattern and white space of the vocabulary file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ODD_SPACE = "\x1c\x1d\x1e\x1f"       # white space for str.split, not for the pattern
MEMO_WORDS = 150_000


def byte_alphabet() -> list[str]:
    """The printable character of each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Symbols and merges of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{"pattern": {}}]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if (model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None
                or pre[0]["pattern"].get("Regex") != WORD_PATTERN or spec["post_processor"] is not None):
            raise ValueError(f"unsupported vocabulary file: {path}")
        vocab = model["vocab"]
        self.token = [""] * (1 + max(max(vocab.values()), *(t["id"] for t in spec["added_tokens"])))
        for t, i in vocab.items():
            self.token[i] = t
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.added.items():
            self.token[i] = t
        alphabet, end = byte_alphabet(), model["end_of_word_suffix"]
        self.by_rank = []                                   # rank -> left symbol, right symbol, new symbol
        self.after: dict[int, dict[int, int]] = {}          # symbol -> symbol on its right -> rank of the pair
        self.before: dict[int, dict[int, int]] = {}         # symbol -> symbol on its left -> rank of the pair
        rank_of = {}
        for rank, (x, y) in enumerate(model["merges"]):
            self.by_rank.append((vocab[x], vocab[y], vocab[x + y]))
            rank_of[vocab[x], vocab[y]] = rank              # of a pair listed twice the later rank counts
        for (x, y), rank in rank_of.items():
            self.after.setdefault(x, {})[y] = rank
            self.before.setdefault(y, {})[x] = rank
        # symbols of the bytes (inside a word, then at its end) and -1 between words; ranks of their pairs or -1
        self.first = np.array([vocab[c] for c in alphabet] + [vocab[c + end] for c in alphabet] + [-1], np.int32)
        self.first_rank = np.array([[self.after.get(x, {}).get(y, -1) for y in self.first.tolist()] for x in self.first.tolist()], np.int32)
        self.word = regex.compile(WORD_PATTERN)
        self.added_ids = {t.upper(): i.to_bytes(4, "little") for t, i in self.added.items()}
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_words(v: Vocabulary, words: list[bytes]) -> list[bytes]:
    """The symbol ids of each word (non-empty UTF-8) after all merges, as
    little-endian 32-bit integers."""
    if not words:
        return []
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    code = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int16)
    code[ends - 1] += 256
    code[ends] = 512
    sym = v.first[code].tolist()              # -1: between words, or merged into the symbol before
    n = len(sym)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks = v.first_rank[code[:-1], code[1:]]
    at = np.flatnonzero(ranks >= 0)
    at = at[np.argsort(ranks[at], kind="stable")]
    active, cuts = np.unique(ranks[at], return_index=True)
    active, cuts, at = active.tolist(), [*cuts.tolist(), len(at)], at.tolist()
    index = {r: at[s:e] for r, s, e in zip(active, cuts, cuts[1:])}          # rank of the pair -> its positions
    none: dict[int, int] = {}
    while active:
        rank = heapq.heappop(active)
        places = index.pop(rank, None)
        if places is None:
            continue
        a, b, new = v.by_rank[rank]
        after, before = v.after.get(new, none).get, v.before.get(new, none).get
        places.sort()
        for k, i in enumerate(places):
            if sym[i] != a or sym[j := nxt[i]] != b:      # gone meanwhile
                continue
            sym[i], sym[j] = new, -1
            nxt[i] = r = nxt[j]
            prv[r] = i
            lower = False
            if (q := after(sym[r])) is not None:
                if (held := index.get(q)) is not None:
                    held.append(i)
                else:
                    index[q] = [i]
                    heapq.heappush(active, q)
                lower = q < rank
            if (q := before(sym[p := prv[i]])) is not None:
                if (held := index.get(q)) is not None:
                    held.append(p)
                else:
                    index[q] = [p]
                    heapq.heappush(active, q)
                lower = lower or q < rank
            if lower:
                index.setdefault(rank, []).extend(places[k + 1:])
                heapq.heappush(active, rank)
                break
    ids = np.array(sym, "<i4")
    live = ids >= 0
    upto = (4 * np.cumsum(live)[ends]).tolist()
    ids = ids[live].tobytes()
    return [ids[s:e] for s, e in zip([0, *upto], upto)]


class Encoder:
    """Encodes batches of texts; holds the memos of chunks and of their words in
    two generations each (when the younger is full it replaces the older one)."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """The normalised white-space-separated chunks.  An added token stands
        in upper case, which no normalised chunk has."""
        out: list[str] = []
        for part in self.v.split_added.split(text) if "<|" in text else (text,):
            if part in self.v.added:
                out.append(part.upper())
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
            if any(c in part for c in ODD_SPACE):
                out.extend(regex.findall(r"\S+", part))
            else:
                out.extend(part.split())
        return out

    def learn(self, chunks: set[str]) -> None:
        """Bring the chunks into the younger generation: from the older one, or
        encoded now, all new ones at once."""
        if len(self.young) + len(chunks) > MEMO_WORDS:
            self.young, self.old = {}, self.young
        new = []
        for c in chunks:
            if c not in self.young:
                if (x := self.old.get(c)) is not None:
                    self.young[c] = x
                else:
                    new.append(c)
        # a chunk of ASCII letters is one word
        split = {c: (c,) if c.isascii() and c.isalpha() else self.v.word.findall(c) for c in new if c not in self.v.added_ids}
        ids = self.merged(set().union(*split.values()))
        for c in new:
            ws = split.get(c)
            self.young[c] = self.v.added_ids[c] if ws is None else ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws])

    def merged(self, words: set[str]) -> dict[str, bytes]:
        """The ids of each word, known from other chunks or merged now."""
        if len(self.words) + len(words) > MEMO_WORDS:
            self.words, self.old_words = {}, self.words
        new = []
        for w in words:
            if w not in self.words:
                if (x := self.old_words.get(w)) is not None:
                    self.words[w] = x
                else:
                    new.append(w)
        self.words.update(zip(new, merge_words(self.v, [w.encode("utf-8", "surrogatepass") for w in new])))
        return self.words

    def encode(self, texts: list[str | None], block: int = 128) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for at in range(0, len(texts), block):
            cut = [self.pieces(t) if t else [] for t in texts[at:at + block]]
            self.learn(set().union(*cut))
            get = self.young.__getitem__
            out.extend([b"".join(map(get, p)) for p in cut])
        return out

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.v.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _fields(df: DataFrame, keep: tuple[str, ...]):
    fields = [f for f in df.schema.fields if f.name in keep]
    return [f.name for f in fields], "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and ``ids``: the token ids as little-endian 32-bit integers."""
    names, ddl = _fields(docs, keep)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        ids = encoder(path).encode(b.column(text).to_pylist())
        return pa.RecordBatch.from_arrays([*map(b.column, names), pa.array(ids, pa.binary())], [*names, "ids"])
    return map_batches(docs.select(*dict.fromkeys([*names, text])), batch, ddl + "ids binary", done=encoder.cache_clear)


def round_trip(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, ``ids`` and the ``decoded`` text of the ids, in one pass (one
    Python worker a task holds the vocabulary, not two)."""
    names, ddl = _fields(docs, keep)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(path)
        ids = enc.encode(b.column(text).to_pylist())
        return pa.RecordBatch.from_arrays([*map(b.column, names), pa.array(ids, pa.binary()), pa.array(map(enc.decode, ids), pa.string())],
                                          [*names, "ids", "decoded"])
    return map_batches(docs.select(*dict.fromkeys([*names, text])), batch, ddl + "ids binary, decoded string", rows=512,
                       done=encoder.cache_clear)


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``ids`` and ``decoded`` text."""
    names, ddl = _fields(encoded, keep)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        enc, ids = encoder(path), b.column("ids")
        text = [enc.decode(x.as_py() or b"") for x in ids]
        return pa.RecordBatch.from_arrays([*map(b.column, names), ids, pa.array(text, pa.string())], [*names, "ids", "decoded"])
    return map_batches(encoded.select(*names, "ids"), batch, ddl + "ids binary, decoded string")
