"""Token counts by deterministic transducers compiled from a tokenizer's file.

Two transducers in a row, both deterministic, whose transitions carry what they emit:

* The **splitter** reads classes of code points (space, letter, digit, other, and the letters that can follow an apostrophe) and
  emits, on each transition, how many pieces begin there (0, 1 or 2; one of them may begin a code point earlier). It has nine states. A slice of
  text is cut into chunks of equal length, all chunks are run at once from every state, which gives each chunk's state map
  (exit state for each entry state), and the maps compose through a parallel prefix scan, so that a chunk's entry
  state is known without reading what stands before it. A second step emits from the known entry states.
* The **counter** reads a piece's bytes and emits how many tokens have become certain. It is the weighted determinisation of the
  automaton whose paths are sequences of tokens in which every two neighbours may stand side by side under the merges; each
  string has one such path, the one that the merges give. A state is a set of (place inside a token, token before it, tokens
  not yet emitted); a transition emits the least of those counts, the last byte of a piece emits what is left. States and
  transitions are compiled when a text first needs them and kept by the worker as one table; beyond ``CELLS`` of it a worker
  begins anew, which changes no count. Each different piece of a slice is read once, all of them together, byte by byte.

Which tokens may stand side by side follows from the merges alone: no two parts along their common edge, alive at one time, may
have a merge that comes before the merges that swallow them. This holds for files in which every token has one merge and its
parts come before it; others are refused. Refused too are normalizers and splitting patterns other than the file's kind
(``KIND``): their classes and states would be others.

Text is normalised first (NFC, lower case code point by code point; code points that Python's tables and the file's library may see
differently go through the library). The special tokens' strings inside a text are one token each, as by the library's default;
none are added around it. Nulls and empty texts have 0 tokens and 0 bytes. White space separates pieces and is no token. Texts
are read whole at any length: very long ones in parts cut at white space, else whole. Repeated rows give repeated rows; an
empty table gives an empty table; other columns are left alone unless they are asked for by name.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemetrics.llm.common import slices, table

#: Bytes of text that are read together, and code points of a chunk.
SLICE, CHUNK = 4 << 20, 96
#: Cells (states x symbols seen) of the counter's table that a worker keeps, at five bytes each, and bytes of different pieces read together.
CELLS, GROUP = 24_000_000, 1 << 19
#: A transition that is not compiled yet.
UNSEEN = -2
#: The kind of file that the two transducers are compiled for (fixed values of the file).
KIND = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "end": "</w>",
}

#: Classes of code points. The letters r, v, l and e need classes of their own; s, t, m, d end a contraction at once.
SPACE, LETTER, DIGIT, OTHER, QUOTE, ENDS, R, V, L, E = range(10)
UNKNOWN = 255
#: States of the splitter: before a piece, in letters, in others, after a quote that began a piece, after such a quote and r, v or l, after a whole piece.
OUT, WORD, MARKS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, WHOLE = range(8)
#: What a transition emits: a piece begins here, a piece began one code point earlier.
BEGINS, BEGAN = 1, 2


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by state and class."""
    letters = {LETTER, ENDS, R, V, L, E}
    to, emits = np.zeros((8, 10), dtype=np.uint8), np.zeros((8, 10), dtype=np.uint8)
    after = {QUOTED_R: E, QUOTED_V: E, QUOTED_L: L}
    for state in range(8):
        for c in range(10):
            if state == QUOTED and c in letters:
                if c in (ENDS, R, V, L):
                    to[state, c] = {ENDS: WHOLE, R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}[c]
                else:
                    to[state, c], emits[state, c] = WORD, BEGINS
                continue
            if state in after:
                if c == after[state]:
                    to[state, c] = WHOLE
                    continue
                emits[state, c] |= BEGAN  # the quote was a piece, and the letter after it begins a word
            within = state in after or state == WORD
            if c == SPACE:
                to[state, c] = OUT
            elif c in letters:
                to[state, c] = WORD
                emits[state, c] |= 0 if within else BEGINS
            elif c == DIGIT:
                to[state, c] = WHOLE
                emits[state, c] |= BEGINS
            elif state in (MARKS, QUOTED):
                to[state, c] = MARKS
            else:
                to[state, c] = QUOTED if c == QUOTE else MARKS
                emits[state, c] |= BEGINS
    return to, emits


def composed(maps: np.ndarray) -> np.ndarray:
    """Inclusive scan of state maps (chunks x states) under composition, by doubling: row i maps the text's entry state to chunk i's exit."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step].astype(np.intp), axis=1)
        step *= 2
    return out


def begins(classes: np.ndarray, to: np.ndarray, emits: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Whether a piece begins at each code point, for a text whose last class is SPACE."""
    n = len(classes)
    rows = -(-n // chunk)
    grid = np.full((rows, chunk), SPACE, dtype=np.uint8)
    grid.ravel()[:n] = classes
    columns = np.ascontiguousarray(grid.T)
    flat, emitted = to.ravel(), emits.ravel()
    maps = np.repeat(np.arange(8, dtype=np.uint8)[None, :], rows, axis=0)
    for column in columns:
        maps = flat[maps.astype(np.intp) * 10 + column[:, None]]
    entry = np.zeros(rows, dtype=np.uint8)
    entry[1:] = composed(maps)[:-1, OUT]
    out = np.empty((chunk, rows), dtype=np.uint8)
    for k, column in enumerate(columns):
        at = entry.astype(np.intp) * 10 + column
        out[k] = emitted[at]
        entry = flat[at]
    marks = np.ascontiguousarray(out.T).ravel()[:n]
    first = (marks & BEGINS) > 0
    first[:-1] |= (marks[1:] & BEGAN) > 0
    return first


class Counter:
    """The counter's transducer, compiled as far as texts have needed it."""

    def __init__(self, model: dict):
        end, vocab = KIND["end"], model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): k for k, (a, b) in enumerate(merges)}
        made = {vocab[a + b]: (vocab[a], vocab[b], k) for k, (a, b) in enumerate(merges)}
        self.parts = made
        birth = {t: k for t, (_, _, k) in made.items()}
        if len(made) < len(merges) or any(birth.get(t, -1) >= k for a, b, k in made.values() for t in (a, b)):
            raise ValueError("every token must have one merge, after the merges of its parts")
        letters = _byte_letters()
        symbol = {vocab[c]: b for b, c in enumerate(letters) if c in vocab} | {vocab[c + end]: 256 + b for b, c in enumerate(letters) if c + end in vocab}
        if len(symbol) < 512:
            raise ValueError("a byte has no token")
        # the tree of the tokens' symbols: node -> {symbol: node}, and the token that ends at a node
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        spelt: dict[int, tuple[int, ...]] = {t: (s,) for t, s in symbol.items()}
        for t, (a, b, _) in sorted(made.items(), key=lambda kv: kv[1][2]):
            spelt[t] = spelt[a] + spelt[b]
        for t, symbols in spelt.items():
            node = 0
            for s in symbols:
                if s not in self.child[node]:
                    self.child[node][s] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = self.child[node][s]
            self.token[node] = t
        self.rights = {t: self._spine(t, 1) for t in spelt}
        self.lefts = {t: self._spine(t, 0) for t in spelt}
        self.whole = {t: self._stands(t) for t in spelt}
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.columns = np.full(512, -1, dtype=np.int32)  # the table's column of each symbol that texts have held
        self.symbols: list[int] = []
        self.next = np.full((1024, 64), UNSEEN, dtype=np.int32)
        self.emits = np.zeros((1024, 64), dtype=np.uint8)
        self._state(((0, -1, 0),))

    def _room(self, rows: int, width: int) -> None:
        have = self.next.shape
        if rows > have[0] or width > have[1]:
            shape = (max(have[0], rows * 3 // 2 if rows > have[0] else 0), max(have[1], width + 32 if width > have[1] else 0))
            for name, fill in (("next", UNSEEN), ("emits", 0)):
                old = getattr(self, name)
                new = np.full(shape, fill, dtype=old.dtype)
                new[: have[0], : have[1]] = old
                setattr(self, name, new)

    def _spine(self, t: int, side: int) -> list[tuple[int, int]]:
        """The parts of a token along one edge, largest first, each with the rank of the merge that swallows it."""
        out, until = [], 1 << 30
        while True:
            out.append((t, until))
            if t not in self.parts:
                return out
            a, b, until = self.parts[t]
            t = b if side else a

    def _stands(self, t: int) -> bool:
        """Whether the merges give the token for its own string: its two parts may not stand side by side without its own merge."""
        if t not in self.parts:
            return True
        a, b, k = self.parts[t]
        return self._stands(a) and self._stands(b) and self._beside(a, b, k)

    def _beside(self, t: int, u: int, own: int = 1 << 30) -> bool:
        """Whether no merge across the edge of t and u comes before merge ``own``. Of equal merges the one further left is first."""
        for x, x_until in self.rights[t]:
            for y, y_until in self.lefts[u]:
                k = self.rank.get((x, y))
                if k is not None and k < own and k < x_until and k <= y_until:
                    return False
        return True

    def beside(self, t: int, u: int) -> bool:
        if t < 0:
            return self.whole[u]
        known = self.pairs.get((t, u))
        if known is None:
            known = self.pairs[t, u] = self.whole[u] and self._beside(t, u)
        return known

    def _state(self, held: tuple) -> int:
        if held not in self.numbers:
            self.numbers[held] = len(self.states)
            self.states.append(held)
        return self.numbers[held]

    def _compile(self, state: int, s: int) -> tuple[int, int]:
        """The transition from a state by a symbol: next state (-1 at a piece's end) and tokens emitted."""
        held, done = [], None
        for node, before, count in self.states[state]:
            to = self.child[node].get(s)
            if to is None:
                continue
            u = self.token[to]
            if u >= 0 and self.beside(before, u):
                if done is not None:
                    raise ValueError("two ways to read one string")
                done = (0, u, count + 1)
            if self.child[to]:
                held.append((to, before, count))
        if done is None:
            raise ValueError("no way to read a string")
        if s >= 256:
            return -1, done[2]
        held.append(done)
        least = min(c for _, _, c in held)
        return self._state(tuple(sorted((n, b, c - least) for n, b, c in held))), least

    def _fill(self, states: np.ndarray, columns: np.ndarray) -> None:
        """Compiles the transitions of these states and columns that are missing."""
        width = len(self.columns)
        for key in np.unique(states.astype(np.int64) * width + columns).tolist():
            state, column = divmod(key, width)
            to, n = self._compile(state, self.symbols[column])
            self._room(len(self.states), len(self.symbols))
            self.next[state, column], self.emits[state, column] = to, n

    def _run(self, at: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Tokens of pieces (place and size in ``data``), largest first, read byte by byte together."""
        state, total = np.zeros(len(at), dtype=np.int32), np.zeros(len(at), dtype=np.int64)
        ends = np.searchsorted(-sizes, -np.arange(sizes[0] + 1))  # pieces longer than k: ends[k]
        for k in range(int(sizes[0])):
            n = int(ends[k])
            s = data[at[:n] + k].astype(np.int32)
            s[int(ends[k + 1]) : n] += 256
            columns, now = self.columns[s], state[:n]
            to = self.next[now, columns]
            miss = to == UNSEEN
            if miss.any():
                self._fill(now[miss], columns[miss])
                to = self.next[now, columns]
            total[:n] += self.emits[now, columns]
            state[:n] = to
        return total

    def counts(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Tokens of each piece; ``offsets`` cuts the bytes ``data`` into pieces, none empty."""
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        groups = np.cumsum(sizes[order]) // GROUP
        cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(order)]
        out = np.zeros(len(sizes), dtype=np.int64)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if len(self.states) * max(64, len(self.symbols)) > CELLS:
                self.clear()
            part = order[a:b]
            for s in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
                if self.columns[s] < 0:
                    self.columns[s], self.columns[s + 256] = len(self.symbols), len(self.symbols) + 1
                    self.symbols += [s, s + 256]
            self._room(len(self.states), len(self.symbols))
            out[part] = self._run(offsets[:-1][part], sizes[part], data)
        return out


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the file: printable ones for themselves, the others from 256 on, in order (a fixed rule of such files)."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Tokens:
    """The transducers of one file, and what the worker has learned of code points."""

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        given = json.loads(file)
        split = given["pre_tokenizer"]["pretokenizers"][0]
        if given["normalizer"] != KIND["normalizer"] or split["pattern"] != {"Regex": KIND["pattern"]} or given["model"]["end_of_word_suffix"] != KIND["end"]:
            raise ValueError("a file of another kind")
        library = Tokenizer.from_str(file.decode())
        self.normalizer, self.splits = library.normalizer, library.pre_tokenizer
        self.special = re.compile("|".join(re.escape(t["content"]) for t in given["added_tokens"]) or r"(?!)")
        self.to, self.emits = splitter()
        self.counter = Counter(given["model"])
        self.classes = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self.odd: set[str] = set()
        letters = {"r": R, "v": V, "l": L, "e": E} | dict.fromkeys("stmd", ENDS)
        for c in map(chr, range(128)):
            self.classes[ord(c)] = QUOTE if c == "'" else letters.get(c, self._class(c))

    def _class(self, c: str) -> int:
        """As the library sees it: a letter joins a letter, a digit stands alone, white space is no piece."""
        pieces = self.splits.pre_tokenize_str(c + c)
        if not pieces:
            return SPACE
        if len(pieces) == 2:
            return DIGIT
        return LETTER if len(self.splits.pre_tokenize_str("a" + c)) == 1 else OTHER

    def _learn(self, points: np.ndarray) -> None:
        for c in map(chr, points.tolist()):
            self.classes[ord(c)] = self._class(c)

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        if any(c in self.odd for c in self._strange(text)):
            return self.normalizer.normalize_str(text)
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def _strange(self, text: str) -> set[str]:
        """The text's code points, each held against the library once: odd ones are those that Python lower-cases or composes in its own way."""
        found = set(text)
        for c in found - self.__dict__.setdefault("met", set()):
            self.met.add(c)
            own = unicodedata.normalize("NFC", c).replace("Σ", "σ").lower()
            if unicodedata.category(c) == "Cn" or self.normalizer.normalize_str(c) not in (own, " "):
                self.odd.add(c)
        return found

    def _counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, none of which holds a special token."""
        import pyarrow as pa

        normal = [self.normal(t) for t in texts]
        points = np.frombuffer(" ".join([*normal, ""]).encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(t) + 1 for t in normal])
        classes = self.classes[points]
        if (classes == UNKNOWN).any():
            self._learn(np.unique(points[classes == UNKNOWN]))
            classes = self.classes[points]
        first = begins(classes, self.to, self.emits)
        solid = classes != SPACE
        at = np.cumsum(first)[ends - 1] if len(ends) else np.zeros(0, dtype=np.int64)  # pieces up to each text's end
        kept = points[solid]
        width = 1 + (kept >= 0x80).astype(np.int8) + (kept >= 0x800) + (kept >= 0x10000)
        offsets = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
        starts = offsets[np.concatenate((np.flatnonzero(first[solid]), [len(kept)]))]
        data = kept.astype("<u4").tobytes().decode("utf-32-le").encode()
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        different = pieces.dictionary
        cut = np.frombuffer(different.buffers()[1], np.int64)[different.offset : different.offset + len(different) + 1] if len(different) else np.zeros(1, np.int64)
        each = self.counter.counts(cut, np.frombuffer(different.buffers()[2] or b"", np.uint8)) if len(different) else np.zeros(0, np.int64)
        sums = np.concatenate(([0], np.cumsum(each[pieces.indices.to_numpy()] if len(each) else each)))
        return np.diff(sums[at], prepend=0)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text; nulls have none."""
        whole, part, run, size = np.zeros(len(texts), dtype=np.int64), [], [], 0

        def flush() -> None:
            nonlocal size
            if part:
                np.add.at(whole, run, self._counts(part))
            part.clear()
            run.clear()
            size = 0

        for k, text in enumerate(texts):
            if not text:
                continue
            if "<|" in text:
                whole[k] += len(self.special.findall(text))
                text = self.special.sub(" ", text)
            for a, b in _cuts(text, SLICE):
                part.append(text[a:b])
                run.append(k)
                size += b - a
                if size >= SLICE:
                    flush()
        flush()
        return whole


def _cuts(text: str, most: int) -> Iterator[tuple[int, int]]:
    """Parts of about ``most`` code points, cut at white space; a stretch without any stays whole."""
    start = 0
    while len(text) - start > most:
        space = re.compile(r"[ \t\n]").search(text, start + most)
        if not space:
            break
        yield start, space.start()
        start = space.start()
    yield start, len(text)


_TOKENS: dict[bytes, Tokens] = {}


def _tokens(file: bytes) -> Tokens:
    """One set of transducers for each worker process, kept between its tasks."""
    import hashlib

    key = hashlib.sha256(file).digest()
    if key not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[key] = Tokens(file)
    return _TOKENS[key]


def count_tokens(df: DataFrame, keep: list[str], file: bytes, source: str = "text", limit: int = 2048) -> DataFrame:
    """``keep`` columns, then n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of each text."""
    rows = df.select(*keep, F.col(source).alias("__source"))
    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    shared = df.sparkSession.sparkContext.broadcast(file)  # a tokenizer's file: its size does not follow the data

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        tokens = _tokens(shared.value)
        for whole in batches:
            for batch in slices(whole, "__source", SLICE):
                texts = batch.column("__source")
                n = tokens.counts(texts.to_pylist())
                sizes = pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), sizes, pa.array(n), pa.array(n > limit)], names=schema.names)

    return rows.mapInArrow(run, schema)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text of documents by the file's merges."""
    import public_tokenizers as tokenizers

    with open(tokenizers.path("word_bpe_49k.json"), "rb") as f:
        file = f.read()
    return count_tokens(table(spark, sf_dir, "documents"), ["doc_id"], file)


QUERIES = {"op13_token_counts": op13_token_counts}
SQL: dict[str, str] = {}
