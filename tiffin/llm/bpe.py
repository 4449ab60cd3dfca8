"""BPE encoding and decoding by speculation and verification.

Words are proposed as greedy longest matches in the vocabulary. A sequence of tokens is the BPE encoding of a word
exactly if every adjacent pair is the encoding of its own text, so the pairs of all new words of a batch are checked
at once with numpy against a table of judged pairs; only words with a failing pair undergo exact merging. Each task
keeps a bounded table of words already encoded.

Handles vocabulary files of the tokenizers library of the kind "BPE with word ends": NFC, white space dropped, lower
case, byte-level symbols, `</w>` after the last symbol of a word. The file's bytes (a few MB at most) are broadcast.

Defined cases: null counts as empty; empty texts have no tokens; special tokens are found in texts as the library
does by default; ids, repeated rows and other columns do not matter.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import texts
from ._spark import free_names, small_batches

#: Words that a task remembers; bytes of text encoded at once.
REMEMBERED, TEXTS = 100_000, 1 << 17
END = "</w>"
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: Letters and digits that came after Unicode 16, which the library does not know as such, in hexadecimal.
_LATER_LETTERS = """
558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7
10ed9-10eee 11b0a 11db0-11ddb 11df1 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2
18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2
1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f
"""
_LATER_DIGITS = "11de0-11de9 1246f 12475-1247f 12550-12686 16ff4-16ff6"
#: Letters that the library lower-cases and an older Unicode does not know, with what they become.
_LATER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_LATER_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def _class(ranges: str) -> str:
    return "".join("-".join(f"\\U{int(x, 16):08x}" for x in r.split("-")) for r in ranges.split())


_L, _N = rf"[\p{{L}}--[{_class(_LATER_LETTERS)}]]", rf"[\p{{N}}--[{_class(_LATER_DIGITS)}]]"
#: Words of texts in which any of these occurs.
_LATER = re.compile(f"[{_class(_LATER_LETTERS)}{_class(_LATER_DIGITS)}{''.join(map(chr, _LATER_LOWER))}]")
_LATER_WORD = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{_L}+|{_N}|[^{_SPACE}{_L}{_N}]+")
#: The same as _WORD for texts of ASCII and Latin letters only.
_LATIN_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\u024f]+|[0-9]|[^{_SPACE}0-9a-z\xdf-\xf6\xf8-\u024f]+")
_EXOTIC = re.compile(r"[^\x00-\x7f\xdf-\xf6\xf8-\u024f]")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


SYMBOLS = _byte_symbols()
#: For str.translate after reading bytes as Latin-1.
_TRANSLATE = dict(enumerate(SYMBOLS))


class WordBpe:
    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END:
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.token = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.kind = "H" if max(self.token, default=0) < 1 << 16 else "I"  # of the arrays of ids
        self.longest: dict[str, int] = {}  # of the tokens that begin with these three symbols
        for t in self.vocab:
            n = len(t) - (len(END) if t.endswith(END) else 0)
            if n > 2:
                self.longest[t[:3]] = max(self.longest.get(t[:3], 3), n)
        self.judged: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}  # ids of words, as integers of `kind`
        self.older: dict[str, bytes] = {}
        self.names = [self.token.get(i, "") for i in range(max(self.token, default=-1) + 1)]
        self.numbers = [str(i) for i in range(len(self.names))]

    def forget(self) -> None:
        """Give up the words met, so that a worker that goes on to other work holds the vocabulary alone."""
        self.known, self.older, self.judged = {}, {}, {}

    def normalise(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if text.isascii() or not _EXOTIC.search(text):
            return _LATIN_WORD.findall(text)
        if _LATER.search(text):
            return _LATER_WORD.findall(text.translate(_LATER_LOWER))
        return _WORD.findall(text)

    def symbols(self, word: str) -> str:
        return word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(_TRANSLATE)

    def propose(self, s: str) -> list[int]:
        out, i, n, vocab = [], 0, len(s), self.vocab
        while i < n:
            most = min(self.longest.get(s[i : i + 3], 2), n - i)
            for k in range(most, 0, -1):
                t = vocab.get(s[i : i + k] + END if i + k == n else s[i : i + k])
                if t is not None:
                    break
            else:
                raise ValueError(f"no token for {s[i]!r}")
            out.append(t)
            i += k
        return out

    def parts(self, token: int) -> list[str]:
        t = self.token[token]
        return [*t[: -len(END) - 1], t[-len(END) - 1 :]] if t.endswith(END) and len(t) > len(END) else list(t)

    def merge(self, parts: list[str]) -> list[int]:
        """Exact merging: best rank first and leftmost among equals."""
        if len(parts) > 64:
            return self.merge_long(parts)
        get, none = self.rank.get, len(self.rank)
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
        return [self.vocab[p] for p in parts]

    def merge_long(self, parts: list[str]) -> list[int]:
        """The same over a linked list with a heap, for words of any length."""
        n, rank = len(parts), self.rank
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i] if alive[i] else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i] = a + b
            alive[j] = False
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := rank.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            if (h := left[i]) >= 0 and (r := rank.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return [self.vocab[p] for p, live in zip(parts, alive) if live]

    def judge(self, pair: int) -> bool:
        """Whether the tokens pair >> 32 and pair & (2 ** 32 - 1), less one, are the encoding of their text."""
        a, b = pair >> 32, (pair & 0xFFFFFFFF) - 1
        tokens = [a] if b < 0 else [a, b]
        return self.merge([p for t in tokens for p in self.parts(t)]) == tokens

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet."""
        symbols = [self.symbols(w) for w in words]
        tokens = [self.propose(s) for s in symbols]
        size = np.array([len(t) for t in tokens])
        flat = np.array([x for t in tokens for x in t], np.int64)
        last = np.cumsum(size) - 1
        pair = np.empty(len(flat), np.int64)
        pair[:-1] = flat[:-1] << 32 | flat[1:] + 1
        pair[last] = np.where(size > 1, -1, flat[last] << 32)  # a word of one token is judged by itself
        distinct, back = np.unique(pair, return_inverse=True)
        judged = self.judged
        good = np.array([p < 0 or (judged[p] if p in judged else judged.setdefault(p, self.judge(p))) for p in distinct.tolist()], bool)
        right = np.logical_and.reduceat(good[back], last - size + 1)
        for w, s, t, ok in zip(words, symbols, tokens, right.tolist()):
            if not ok:
                t = self.merge([*s[:-1], s[-1] + END])
            self.known[w] = array(self.kind, t).tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """For every text its ids, as 16-bit integers (32-bit, if need be)."""
        pieces = []
        for text in texts:
            if self.split and "<|" in text and (cut := self.split.split(text))[1:]:
                pieces.append([w for k, x in enumerate(cut) for w in ([x] if k % 2 else self.normalise(x))])
            else:
                pieces.append(self.normalise(text))
        if len(self.known) > REMEMBERED:  # the words not met since the last time go
            self.older, self.known = self.known, {}
        if len(self.judged) > REMEMBERED:
            self.judged.clear()
        fresh = set().union(*pieces) - self.known.keys()
        if again := fresh & self.older.keys():
            older = self.older
            self.known.update((w, older[w]) for w in again)
            fresh -= again
        if fresh:
            for s in fresh & self.special.keys():
                self.known[s] = array(self.kind, [self.special[s]]).tobytes()
            if words := list(fresh - self.special.keys()):
                self.learn(words)
        known = self.known
        return [b"".join([known[w] for w in p]) for p in pieces]

    def ids(self, raw: bytes) -> list[int]:
        return array(self.kind, raw).tolist()


@functools.lru_cache(maxsize=1)
def _loaded(digest: str) -> list[WordBpe]:
    return []


def tokenizer(raw: bytes) -> WordBpe:
    """One tokenizer for all tasks of a Python worker."""
    if not (held := _loaded(hashlib.sha1(raw).hexdigest())):
        held.append(WordBpe(raw))
    return held[0]


def text_batches(column: pa.Array):
    """(first row, texts) with about TEXTS characters each; null as empty."""
    at, size, held = 0, 0, []
    for i, t in enumerate(texts(column)):
        held.append(t or "")
        size += len(held[-1])
        if size >= TEXTS:
            yield at, held
            at, size, held = i + 1, 0, []
    if held:
        yield at, held


#: What bpe_encode can add, with types.
OUTPUTS = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def vocabulary(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def bpe_encode(docs: DataFrame, path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), keep: tuple[str, ...] | None = None, text_col: str = "text") -> DataFrame:
    """The columns `keep` (all by default) of `docs` and of each text its token ids and what they decode to.

    An output takes the place of a column of its name.

    Decoding is the library's for a file without a decoder: the tokens joined by spaces. `path` is read by the driver.
    """
    small_batches(docs.sparkSession)
    keep = tuple(c for c in (docs.columns if keep is None else keep) if c not in outputs)
    shared, names = vocabulary(docs, path), [*keep, *outputs]
    # fmt: off
    make = {
        "n_tokens": (pa.int64(), lambda bpe, e: len(e)),
        "ids": (pa.list_(pa.int32()), lambda bpe, e: e),
        "decoded": (pa.string(), lambda bpe, e: " ".join([bpe.names[i] for i in e])),
        "ids_sha256": (pa.string(), lambda bpe, e: hashlib.sha256(" ".join([bpe.numbers[i] for i in e]).encode()).hexdigest()),
        "decoded_sha256": (pa.string(), lambda bpe, e: hashlib.sha256(" ".join([bpe.names[i] for i in e]).encode()).hexdigest()),
    }
    # fmt: on

    def scan(batches):
        bpe = tokenizer(shared.value)
        for b in batches:
            for at, some in text_batches(b.column(b.num_columns - 1)):
                ids = [bpe.ids(raw) for raw in bpe.encode_batch(some)]
                made = [pa.array([make[o][1](bpe, e) for e in ids], make[o][0]) for o in outputs]
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(some)) for c in b.columns[:-1]), *made], names=names)
        bpe.forget()

    kept = docs.select(*(F.col(f"`{c}`") for c in keep))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [f"{o} {OUTPUTS[o]}" for o in outputs])
    return docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias(free_names(docs, "text_to_encode")[0])).mapInArrow(scan, schema)
