"""BPE encoding and decoding by a depth-first walk over the trie of distinct words.

A task collects the distinct words of a batch of documents and visits them in
sorted order, which is a depth-first walk of their trie. For every prefix it
keeps the last token of the prefix's encoding; a word goes on from the prefix it
shares with the word before, so shared prefixes are encoded once, and its
encoding is read backwards from its last token, so memory is linear in its length. A prefix's last token is the one vocabulary entry ``t`` ending
there that may stand after the last token of what precedes ``t``. Two tokens
may stand side by side unless the merges would join across their border before
their own merges are through (``_Vocabulary.may_follow``).

Normalisation and pre-tokenisation of words outside ASCII are those of the
tokenizer file itself, through the tokenizers library; merges are done here.

Plan: one pass, no shuffle. The tokenizer file (a few MB) is read on the driver
and broadcast, and parsed once a Python worker. Memory per task: one Arrow batch, the words of some
``HELD_CHARS`` characters of it, and a word
cache of about ``CACHE_WORDS`` entries, which the worker keeps for its next task (it changes no
result). Latin texts are split into pieces as a whole, others word by word.

Defined results: a null or empty text has no tokens and decodes to ''; texts of
any length are split in slices at white space; repeated rows give repeated
rows; other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from itemscope.llm.common import Recent

CACHE_WORDS = 200_000
#: Token pairs whose fit is remembered by a task.
CACHE_PAIRS = 150_000
SLICE_CHARS = 1 << 20
#: Characters of the texts whose words are held at once, a text of any length at least.
HELD_CHARS = 1 << 20
_ASCII_SPACE = re.compile(r"[ \t\n\x0b\x0c\r]+")
#: The tokenizer file's split pattern, spelled for printable characters below
#: U+0250, where normalisation only lower-cases: contractions, letters, one number, the rest.
_LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|[\W_]+")
#: Whole texts of such characters and ASCII white space, and the same pattern for them, the most frequent kind first.
_LATIN_TEXT = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\xa1-\xac\xae-\u012f\u0131-\u024f]*")
_TEXT_PIECES = re.compile(r"[^\W\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|'(?:s|t|re|ve|m|ll|d)|(?:[^\w\s]|_)+")
_LATIN_END = "\u0250"
#: ASCII separators that str.split() would add to the tokenizer's white space.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


def _byte_letters() -> list[str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for the letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class _Vocabulary:
    """Token ids, merge ranks and border spines of one tokenizer file."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        spec = json.loads(content)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.halves = {a + b: (a, b) for a, b in pairs}
        self.longest = max(len(t.removesuffix(self.end)) if self.end else len(t) for t in self.ids)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = dict(enumerate(_byte_letters()))
        self.packed = {t: i.to_bytes(4, "little") for t, i in self.ids.items()}
        self.library = Tokenizer.from_str(content)
        names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        size = max(names) + 1
        self.tokens = pa.array([names.get(i, "") for i in range(size)], pa.string())
        self.right: dict[str, list[tuple[str, int]]] = {}
        self.left: dict[str, list[tuple[str, int]]] = {}
        #: Every token's packed id and what is known of the tokens before it (does it fit?).
        self.entries: dict[str, tuple[bytes, dict[str, bool]]] = {t: (code, {}) for t, code in self.packed.items()}
        self.pairs = 0
        self.cache = Recent()

    def _spine(self, token: str, side: int, known: dict) -> list[tuple[str, int]]:
        """The tokens that stand at one border of ``token`` while it is built,
        each with the rank of the merge that takes it up."""
        if token not in known:
            steps, at, taken = [], token, len(self.rank) + 1
            while True:
                steps.append((at, taken))
                if at not in self.halves:
                    break
                taken = self.rank[self.halves[at]]
                at = self.halves[at][side]
            known[token] = steps
        return known[token]

    def may_follow(self, a: str, b: str) -> bool:
        """True if the merges leave ``a`` and ``b`` side by side: no pair at the
        border is merged while both its tokens still stand (of equal ranks the
        left merge comes first)."""
        got = self.entries[b][1].get(a)
        if got is None:
            got = True
            for x, x_taken in self._spine(a, 1, self.right):
                for y, y_taken in self._spine(b, 0, self.left):
                    r = self.rank.get((x, y))
                    if r is not None and r < x_taken and r <= y_taken:
                        got = False
            if self.pairs > CACHE_PAIRS:
                for _, fits in self.entries.values():
                    fits.clear()
                self.pairs = 0
            self.entries[b][1][a] = got
            self.pairs += 1
        return got

    def pieces(self, chunk: str) -> list[str]:
        """The byte-level pieces of a text without white space and special tokens."""
        if chunk.isprintable() and max(chunk) < _LATIN_END:
            found = _LATIN_PIECES.findall(chunk.lower())
            return found if chunk.isascii() else [p.encode().decode("latin-1").translate(self.letters) for p in found]
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))]

    def walk(self, words: Iterable[str]) -> dict[str, bytes]:
        """Encodings (packed int32) of byte-level words, by a depth-first walk of their trie.

        Exactly one start fits for a prefix, so the starts may be tried in
        any order: the likeliest are the last token grown by one letter and
        the letter alone."""
        packed, entries, end, longest, may_follow = self.packed, self.entries, self.end, self.longest, self.may_follow
        out: dict[str, bytes] = {}
        last: list[str] = [""]       # by prefix length: the last token of the prefix's encoding
        before = ""
        for word in sorted(words):
            n = len(word)
            known = min(len(last), n)
            shared = 0
            while shared + 1 < known and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1:]
            for stop in range(shared + 1, n + 1):
                tail = end if stop == n else ""
                start = grown = stop - 1 - len(last[stop - 1])
                others = None
                while True:
                    token = word[start:stop] + tail
                    entry = entries.get(token)
                    if entry is not None:
                        prev = last[start]
                        if not prev:
                            break
                        fits = entry[1].get(prev)
                        if may_follow(prev, token) if fits is None else fits:
                            break
                    if others is None:
                        others = chain((stop - 1,), range(grown + 1, stop - 1), range(grown - 1, max(-1, stop - longest - 1), -1))
                    start = next(others)
                if tail:
                    parts = [entry[0]]
                    while start:
                        parts.append(packed[last[start]])
                        start -= len(last[start])
                    out[word] = b"".join(parts[::-1])
                else:
                    last.append(token)
            before = word
        return out

    def units(self, text: str) -> tuple[bool, list[str]]:
        """What a text is encoded by: (True, its pieces) if it is Latin, else (False, its chunks between white space)."""
        if _LATIN_TEXT.fullmatch(text) and not ("<" in text and self.special_split is not None and self.special_split.search(text)):
            return True, _TEXT_PIECES.findall(text.lower())
        return False, _chunks(text)

    def learn(self, chunks: set[str], pieces: set[str] = frozenset()) -> None:
        """Put the encodings of the chunks and of the Latin pieces (which are chunks of one piece) into the cache."""
        parts: dict[str, list[str | int]] = {}
        for chunk in self.cache.missing(chunks | pieces, CACHE_WORDS):
            if chunk in pieces:
                parts[chunk] = [chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.letters)]
            elif self.special_split is not None and "<" in chunk and self.special_split.search(chunk):
                mixed: list[str | int] = []
                for x in self.special_split.split(chunk):
                    mixed += [self.special[x]] if x in self.special else self.pieces(x) if x else []
                parts[chunk] = mixed
            else:
                parts[chunk] = self.pieces(chunk)
        codes = self.walk({p for ps in parts.values() for p in ps if isinstance(p, str)})
        for chunk, ps in parts.items():
            self.cache.now[chunk] = codes[ps[0]] if len(ps) == 1 and isinstance(ps[0], str) else b"".join(
                [codes[p] if isinstance(p, str) else p.to_bytes(4, "little") for p in ps])

    def encode(self, chunks: list[str], latin: bool = False) -> bytes:
        """The packed encoding of consecutive chunks, or of the pieces of a Latin text."""
        known = self.cache.now
        try:
            return b"".join([known[c] for c in chunks])
        except KeyError:  # the cache has forgotten some meanwhile
            self.learn(set() if latin else set(chunks), set(chunks) if latin else set())
            known = self.cache.now
            return b"".join([known[c] for c in chunks])


_LOADED: dict[int, _Vocabulary] = {}


def _vocabulary(content: str) -> _Vocabulary:
    """One parsed vocabulary per Python worker."""
    key = hash(content)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = _Vocabulary(content)
    return _LOADED[key]


def _slices(text: str) -> Iterator[str]:
    lo = 0
    while len(text) - lo > SLICE_CHARS and (m := _ASCII_SPACE.search(text, lo + SLICE_CHARS)):
        yield text[lo:m.start()]
        lo = m.end()
    yield text[lo:]


def _parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in a row, HELD_CHARS characters or one text at a time."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size >= HELD_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _chunks(text: str) -> list[str]:
    if any(c in text for c in _NOT_SPACE):
        return [c for c in _ASCII_SPACE.split(text) if c]
    return text.split()


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def encoder(content: str, text: int, out: str) -> Step:
    """Adds the token ids of the text in column number ``text`` as list<int32>."""

    def run(batches):
        v = _vocabulary(content)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            packed: list[bytes] = []
            for part in _parts(texts):
                short = [v.units(t) if t and len(t) <= SLICE_CHARS else None for t in part]
                v.learn(set().union(*[u for latin, u in filter(None, short) if not latin]),
                        set().union(*[u for latin, u in filter(None, short) if latin]))
                packed += [v.encode(u[1], u[0]) if u else b"".join(v.encode(units, latin) for latin, units in map(v.units, _slices(t or "")))
                           for t, u in zip(part, short)]
            offsets = np.zeros(len(texts) + 1, dtype=np.int32)
            np.cumsum([len(c) // 4 for c in packed], out=offsets[1:])
            flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(packed))])
            yield _with_column(batch, out, pa.ListArray.from_arrays(pa.array(offsets), flat))

    return run


def decoder(content: str, ids: str, out: str) -> Step:
    """Adds the text of the ids: the tokens joined by one space (the file names no decoder)."""

    def run(batches):
        v = _vocabulary(content)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            taken = v.tokens.take(lists.flatten())
            joined = pc.binary_join(pa.ListArray.from_arrays(_offsets(lists), taken), " ")
            yield _with_column(batch, out, joined)

    return run


def _offsets(lists: pa.ListArray) -> pa.Array:
    at = lists.offsets.to_numpy()
    return pa.array(at - at[0])


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def apply(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None,
          carry: list[str] | None = None, then: Step | None = None, then_schema: str | None = None) -> DataFrame:
    """The columns ``carry`` (all by default, the text included) of every row
    with the token ids of its whole text and, if asked for, their decoding.

    ``then`` (with ``then_schema``) is a last step over the Arrow batches, for
    what a caller derives from ids and texts in the same task."""
    kept = docs.columns if carry is None else carry
    content = docs.sparkSession.sparkContext.broadcast(_read(path))
    narrow = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(kept)], docs[text].cast("string").alias("t"))
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)]
    fields += [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])

    def run(batches):
        steps = encoder(content.value, len(kept), ids)(batches)
        steps = (b.drop_columns(["t"]) for b in steps)
        if decoded:
            steps = decoder(content.value, ids, decoded)(steps)
        return then(steps) if then else steps

    if then:
        return narrow.mapInArrow(run, then_schema)
    back = [*kept, ids] + ([decoded] if decoded else [])
    return narrow.mapInArrow(run, T.StructType(fields)).toDF(*back)


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the decoding of its column of ids (null: '')."""
    content = rows.sparkSession.sparkContext.broadcast(_read(path))
    names = rows.columns
    narrow = rows.toDF(*[f"c{i}" for i in range(len(names))])
    at = f"c{names.index(ids)}"
    schema = T.StructType([T.StructField(f"c{i}", rows.schema[c].dataType) for i, c in enumerate(names)] + [T.StructField("out", T.StringType())])

    def run(batches):
        for b in decoder(content.value, at, "out")(batches):
            yield b.set_column(len(names), "out", pc.fill_null(b.column(len(names)), ""))

    return narrow.mapInArrow(run, schema).toDF(*names, out)
