"""BPE encoding and decoding over a trie of words that share prefixes.

For byte-pair tokenizers with an end-of-word mark whose words never span white space. The distinct new
words of a batch are put in a trie (held as the sorted list of words; its depth-first walk keeps the
path of the current word as a stack, so memory is one path). Every node keeps the last token of its
prefix's encoding and where that token begins, two whole numbers, and a word's tokens are read back from its
end; so a word costs memory in proportion to its length. The encoding of a prefix is the encoding of the shorter prefix before its last
token, plus that token. So what a prefix shared by many words costs is paid once.

A token t may follow the token u that ends the prefix before it if no merge crosses their border while
the two build up from symbols. That is checked along u's right and t's left edge in order of merge
ranks and remembered per pair. Exactly one token passes at each node: the one that merging by rank gives.

Encodings of white-space chunks are kept per worker up to ``KEEP`` chunks; beyond, those that the texts at
hand don't use are forgotten, so memory is bounded by KEEP and one slice of texts; a lost task is simply run again. There is no shuffle.

Defined results: a null text is empty and has no tokens; special strings inside a text give their own
ids, as the library does by default; decoding joins token strings by one space (these files have no
decoder); repeated rows encode alike; other columns pass through ``encode``; empty tables stay empty.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from market_engine.llm.common import worker_of

KEEP = 400_000
#: Rows that are handed back to Spark at a time.
SLICE = 4000
#: Symbols up to which a word's positions are found only as they are asked for, by recursion.
LONG = 256
_NEVER = 1 << 60
#: Stands for the token before the first.
ROOT = (1 << 20) - 1


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(free)) for b in range(256)]


class WordBpe:
    """A tokenizer file with its merge ranks, spines and the checks between tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        self.version = hashlib.sha256(raw).hexdigest()
        spec = json.loads(raw)
        model = spec["model"]
        self.path, self.end = path, model["end_of_word_suffix"]
        if model["type"] != "BPE" or not self.end or spec["decoder"] or any(
                t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]]
                for t in spec["added_tokens"]):
            raise ValueError(f"{path}: not a word-end byte-pair tokenizer with plain special tokens")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if not (split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed"):
            raise ValueError(f"{path}: its words may span white space")
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {**{i: t for t, i in self.vocab.items()}, **{i: t for t, i in self.special.items()}}
        self.tokens = [ids.get(i, "") for i in range(max(ids) + 1)]
        self.id_bytes = [i.to_bytes(4, "little") for i in range(len(self.tokens))]
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])}
        self.parts = {a + b: (a, b) for a, b in self.rank}
        # white space as the library's patterns have it: not U+001C to U+001F
        self.words = regex.compile(split["pattern"]["Regex"].replace("\\s", "\\t-\\r \\x85\\xa0"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.symbols = dict(enumerate(byte_symbols()))
        self.longest = max(map(len, self.vocab))
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self._library = None

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self.path)
        return self._library

    # ---- tokens side by side
    @lru_cache(maxsize=1 << 17)  # noqa: B019
    def _edge(self, token: str, right: bool) -> tuple[tuple[str, int], ...]:
        """The tokens along one edge of a token's merge tree, from the symbol up, each with the rank at
        which it goes into the next."""
        out, up = [], _NEVER
        while True:
            out.append((token, up))
            if token not in self.parts:
                return tuple(reversed(out))
            pair = self.parts[token]
            up, token = self.rank[pair], pair[right]

    def _apart(self, u: str, t: str, limit: int) -> bool:
        """No merge of rank under ``limit`` joins u and t across their border. Of equal ranks the merge
        further left comes first."""
        x, y = self._edge(u, True), self._edge(t, False)
        i = j = 0
        while True:
            (a, up_a), (b, up_b) = x[i], y[j]
            r = self.rank.get((a, b), _NEVER)
            if r < limit and r < up_a and r <= up_b:
                return False
            if up_a == up_b == _NEVER:
                return True
            if up_a <= up_b:
                i += 1
            else:
                j += 1

    @lru_cache(maxsize=1 << 17)  # noqa: B019
    def whole(self, token: str) -> bool:
        """Merging the token's own symbols gives the token."""
        if token not in self.parts:
            return True
        a, b = self.parts[token]
        return self.whole(a) and self.whole(b) and self._apart(a, b, self.rank[a, b])

    def _follows(self, u: int, t: int) -> bool:
        """Token t may come after token u (ROOT: at the beginning)."""
        if len(self.pairs) > KEEP:
            self.pairs.clear()
        token = self.tokens[t]
        ok = self.whole(token) and (u == ROOT or self._apart(self.tokens[u], token, _NEVER))
        self.pairs[u << 20 | t] = ok
        return ok

    # ---- the trie
    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Token ids (as bytes of int32) of each distinct word of byte symbols, in one walk of their trie.

        ``last[d]`` is the last token of the current word's prefix of d symbols and ``begin[d]`` where that
        token begins, both found when a longer prefix first asks for them and kept for the next words as
        far as they share the prefix."""
        vocab, pairs, id_bytes, follows, end = self.vocab, self.pairs, self.id_bytes, self._follows, self.end
        longest = self.longest
        out: dict[str, bytes] = {}
        last, begin, before = [ROOT], [0], ""

        def extend(word: str, d: int, suffix: str) -> tuple[int, int]:
            """The last token of word[:d] + suffix and where it begins."""
            for j in range(d - longest if d > longest else 0, d):
                t = vocab.get(word[j:d] + suffix)
                if t is not None:
                    u = last[j]
                    if u < 0:
                        u, i = extend(word, j, "")
                        last[j], begin[j] = u, i
                    ok = pairs.get(u << 20 | t)
                    if ok or (ok is None and follows(u, t)):
                        return t, j
            raise ValueError(f"no token ends {word[:d]!r}")

        for word in sorted(words):
            n = len(word)
            shared, most = 0, min(len(last), n) - 1
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1:], begin[shared + 1:]
            last += [-1] * (n - shared - 1)
            begin += [0] * (n - shared - 1)
            if n > LONG:  # in order, so that nothing recurses
                for d in range(shared + 1, n):
                    last[d], begin[d] = extend(word, d, "")
            t, j = extend(word, n, end)
            ids = [id_bytes[t]]
            while j:
                ids.append(id_bytes[last[j]])
                j = begin[j]
            ids.reverse()
            out[word] = b"".join(ids)
            before = word
        return out

    # ---- texts
    def _words_of(self, chunk: str) -> list[str]:
        """Words of a chunk without white space, as byte symbols."""
        if chunk.isascii() or max(chunk) < "\u0300":
            chunk = chunk.lower()
            if chunk.isalpha():
                words = [chunk]
            elif chunk[:-1].isalpha() and chunk[-1] in ".,":
                words = [chunk[:-1], chunk[-1]]
            else:
                words = self.words.findall(chunk)
            if chunk.isascii() and chunk.isprintable():
                return words
            return [w.encode().decode("latin-1").translate(self.symbols) for w in words]
        norm = self.library.normalizer.normalize_str(chunk)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(norm)]

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks that are not known yet."""
        words_of, special = self._words_of, self.special
        pieces: dict[str, list[str]] = {}
        for c in chunks:
            if "<|" in c and self.specials and self.specials.search(c):
                parts = [p for p in self.specials.split(c) if p]
                pieces[c] = [x for p in parts for x in ([p] if p in special else words_of(p))]
            else:
                pieces[c] = words_of(c)
        enc = self.encode_words({w for ws in pieces.values() for w in ws} - special.keys())
        enc.update({w: self.id_bytes[i] for w, i in special.items()})
        for c, ws in pieces.items():
            self.known[c] = enc[ws[0]] if len(ws) == 1 else b"".join([enc[w] for w in ws])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Token ids of each text as bytes of int32."""
        cut = [_chunks(t or "") for t in texts]
        chunks: set[str] = set()
        for cs in cut:
            chunks.update(cs)
        new = chunks.difference(self.known)
        if len(self.known) + len(new) > KEEP:
            self.known = {c: ids for c, ids in self.known.items() if c in chunks}
        collecting = gc.isenabled()
        gc.disable()  # many small objects and no cycles: collecting would only walk them
        try:
            self.learn(new)
        finally:
            if collecting:
                gc.enable()
        get = self.known.__getitem__
        return [b"".join(map(get, cs)) for cs in cut]

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def _chunks(text: str) -> list[str]:
    """Parts between white space as the library sees it; U+001C to U+001F are none."""
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return [c for c in regex.split("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+", text) if c]
    return text.split()


_loaded: dict[str, WordBpe] = {}


def _forget() -> None:
    _loaded.clear()
    WordBpe._edge.cache_clear()
    WordBpe.whole.cache_clear()


def tokenizer(path: str) -> WordBpe:
    """The tokenizer of a file, read once per worker and kept until that works for another step."""
    worker_of("trie_bpe", _forget)
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _ids_array(encoded: list[bytes]) -> pa.Array:
    ends = np.append(0, np.cumsum([len(b) // 4 for b in encoded], dtype=np.int64)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def text_slices(batch, column: int):
    """Slices of a batch with up to SLICE rows and, beyond one row, a few MB of text."""
    sizes = np.cumsum([0 if v is None else v for v in pc.binary_length(batch.column(column)).to_pylist()])
    i = 0
    while i < batch.num_rows:
        before = sizes[i - 1] if i else 0
        j = max(i + 1, min(i + SLICE, int(np.searchsorted(sizes, before + (8 << 20), "right"))))
        yield batch.slice(i, j - i)
        i = j


def _encode(path: str, decode: bool):
    def work(batches):
        bpe = tokenizer(path)
        for batch in batches:
            for part in text_slices(batch, batch.num_columns - 1):
                encoded = bpe.encode(part.column(part.num_columns - 1).to_pylist())
                more, names = [_ids_array(encoded)], ["ids"]
                if decode:  # an Arrow list would make an object of each id first, at several times the cost
                    more.append(pa.array([bpe.decode(memoryview(x).cast("i")) for x in encoded], pa.string()))
                    names.append("decoded")
                yield pa.record_batch([*part.columns[:-1], *more], names=[*part.schema.names[:-1], *names])
    return work


def encode(df: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """All columns of ``df`` (except one named ids, or decoded) plus ids array<int>, and with ``decoded`` the
    text that decoding these ids gives."""
    new = ["ids", *["decoded"] * decoded]
    keep = [c for c in df.columns if c not in new]
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("_text_"))
    schema = df.select(*[F.col(f"`{c}`") for c in keep]).schema.add("ids", ArrayType(IntegerType()))
    return src.mapInArrow(_encode(path, decoded), schema.add("decoded", "string") if decoded else schema)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns of ``df`` plus decoded."""
    keep = [c for c in df.columns if c != "decoded"]

    def work(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "decoded"])
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(ids).alias("_ids_"))
    return src.mapInArrow(work, df.select(*[F.col(f"`{c}`") for c in keep]).schema.add("decoded", "string"))
