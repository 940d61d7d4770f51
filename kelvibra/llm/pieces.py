"""SentencePiece BPE with byte offsets.

A text is first normalised: at every byte the longest prefix that the model's compiled character map knows is
replaced, and for every byte of the result the source byte it came from is recorded. The normalised text is
merged into pieces by the model's scores, and every piece is projected back to the bytes of the source that
it covers. Decoding turns ids into text again.

As no piece of the model has a blank after another character, chunks of one word with the blanks before it
are encoded on their own. The words of a block of texts that a worker has not seen lately are merged together, one step
for all of them; what a word decodes to is put together from its ids. Where a model does have such a piece
the whole text is one chunk. Defined results: a null counts as an empty text, an empty text has no pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import functions as F

from kelvibra.llm.words import mix, worker_cache

BLANK = "▁"
CHUNK = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
REMEMBERED = 110_000
SHORT = 64  # characters of a word that is merged with others
AT_ONCE = 5_000  # words that are merged together
BLOCK_ROWS = 100
LOWEST = float("-inf")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in a model file


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at
    at = 0
    while at < len(message):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        elif tag & 7 == 2:
            size, at = varint(at)
            value, at = message[at:at + size], at + size
        else:
            size = 8 if tag & 7 == 1 else 4
            value, at = message[at:at + size], at + size
        yield tag >> 3, value


class CharacterMap:
    """A compiled character map: a double-array trie of byte strings, whose values are places in a block of
    replacement strings, each closed by a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.strings = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of data[at:]."""
        if not self.units:
            return None
        found, node = None, self._child(0, self.units[0])
        for k in range(at, len(data)):
            byte = data[k]
            node ^= byte
            if node >= len(self.units) or (unit := self.units[node]) & 0x800000FF != byte:
                break
            node = self._child(node, unit)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                found = k + 1 - at, self.strings[value:self.strings.index(b"\0", value)]
        return found

    @staticmethod
    def _child(node: int, unit: int) -> int:
        return node ^ (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """Longest-prefix normalisation with the source byte of every byte of the result."""

    def __init__(self, spec: bytes, users: list[bytes] = ()):
        values = dict(fields(spec))
        self.map = CharacterMap(values.get(2, b""))
        self.dummy, self.trim, self.escape = (bool(values.get(k, 1)) for k in (3, 4, 5))
        self.blank = BLANK.encode() if self.escape else b" "
        self.users = re.compile(b"|".join(map(re.escape, sorted(users, key=len, reverse=True)))) if users else None
        self.plain = not self.map.units and not self.trim

    def _prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        if self.users and (m := self.users.match(data, at)):
            return len(m[0]), m[0]
        if found := self.map.longest(data, at):
            return found
        first = data[at]
        size = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return size, data[at:at + size]

    def __call__(self, data: bytes) -> tuple[bytes, list[int]]:
        """The normalised bytes and, for each of them and for the end, the place in `data`."""
        out, places, at = bytearray(), [], 0

        def put(text: bytes, place: int) -> None:
            same = data.startswith(text, place)  # left as it was, byte for byte
            out.extend(text)
            places.extend(range(place, place + len(text)) if same else [place] * len(text))
        if self.trim:
            while at < len(data) and (step := self._prefix(data, at))[1].strip(b" ") == b"":
                at += step[0]
        if at < len(data) and self.dummy:
            put(self.blank, at)
        after_blank = self.trim
        while at < len(data):
            size, text = self._prefix(data, at)
            if after_blank:
                text = text.lstrip(b" ")
            if text:
                put(text.replace(b" ", self.blank), at)
                after_blank = self.trim and text.endswith(b" ")
            at += size
        if self.trim:
            while out.endswith(self.blank):
                del out[-len(self.blank):]
                at = places[-len(self.blank)]
                del places[-len(self.blank):]
        return bytes(out), [*places, at]


class Model:
    """Pieces, scores and rules of a model file."""

    def __init__(self, path: str):
        message = sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto()
        pieces, spec = [], b""
        for number, value in fields(message):
            if number == 1:
                own = dict(fields(value))
                score = float(np.frombuffer(own.get(2, b"\0\0\0\0"), "<f4")[0])
                pieces.append((own[1].decode(), score, own.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                spec = value
        if trainer.get(3, 1) != 2:
            raise ValueError("not a BPE model")
        self.texts = [p[0] for p in pieces]
        self.kinds = [p[2] for p in pieces]
        self.ids = {p[0]: i for i, p in enumerate(pieces) if p[2] in (NORMAL, USER, UNUSED)}
        self.scores = {p[0]: p[1] for p in pieces if p[2] in (NORMAL, USER, UNUSED)}
        self.unused = {p[0] for p in pieces if p[2] == UNUSED}
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.bytes = {int(p[0][3:5], 16): i for i, p in enumerate(pieces) if p[2] == BYTE}
        self.byte_values = {i: b for b, i in self.bytes.items()}
        users = [p[0] for p in pieces if p[2] == USER]
        self.normalise = Normaliser(spec, [u.encode() for u in users])
        self.users = re.compile("|".join(map(re.escape, sorted(users, key=len, reverse=True)))) if users else None
        self.by_word = not users and not any(BLANK in t.lstrip(BLANK) for t in self.ids)

    def chunks(self, text: str) -> list[str]:
        """Parts of a normalised text that no piece reaches out of."""
        return CHUNK.findall(text) if self.by_word else [text] if text else []

    def merge(self, text: str) -> list[str]:
        """Pieces of one chunk: the neighbours with the best score are joined until none has one, the first
        of equal ones first."""
        return self._merge_word(text) if self.by_word and not self.unused and len(text) <= 24 \
            else self._merge_long(text)

    def _merge_word(self, text: str) -> list[str]:
        """For a few characters looking through all neighbours is faster than a heap."""
        best, parts = self.scores.get, list(text)
        pairs = [best(a + b, LOWEST) for a, b in zip(parts, parts[1:])]
        while pairs and (top := max(pairs)) > LOWEST:
            i = pairs.index(top)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = best(parts[i - 1] + parts[i], LOWEST)
            if i < len(pairs):
                pairs[i] = best(parts[i] + parts[i + 1], LOWEST)
        return parts

    def _merge_long(self, text: str) -> list[str]:
        symbols, fixed = [], set()
        at = 0
        while at < len(text):
            user = self.users.match(text, at) if self.users else None
            if user:
                fixed.add(len(symbols))
            symbols.append(user[0] if user else text[at])
            at += len(symbols[-1])
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        heap, halves = [], {}

        def offer(a: int, b: int) -> None:
            if a < 0 or b < 0 or a in fixed or b in fixed:
                return
            joined = symbols[a] + symbols[b]
            if joined in self.scores:
                heapq.heappush(heap, (-self.scores[joined], a, b, joined))
                if joined in self.unused:
                    halves[joined] = symbols[a], symbols[b]
        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, joined = heapq.heappop(heap)
            if not symbols[a] or not symbols[b] or symbols[a] + symbols[b] != joined or after[a] != b:
                continue
            symbols[a], symbols[b] = joined, ""
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])

        def whole(piece: str) -> list[str]:
            return [p for half in halves[piece] for p in whole(half)] if piece in halves else [piece]
        return [p for s in symbols if s for p in whole(s)]

    def piece_ids(self, pieces: list[str]) -> list[tuple[int, int]]:
        """Ids with the normalised bytes each covers; an unknown piece falls back to its bytes, the first of
        which stands for the piece's span."""
        out: list[tuple[int, int]] = []
        for p in pieces:
            size = len(p.encode())
            if p in self.ids:
                out.append((self.ids[p], size))
            elif self.bytes:
                out.extend((self.bytes[b], 1) for b in p.encode())
            else:
                out.append((self.unknown, size))
        return out

    def encode(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids of a text and the bytes of the source that each piece covers, from and to."""
        data, places = self.normalise(text.encode())
        ids, spans, at = [], [], 0
        for chunk in self.chunks(data.decode()):
            for number, size in self.piece_ids(self.merge(chunk)):
                ids.append(number)
                spans.append((places[at], places[at + size]))
                at += size
        return ids, spans

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        out, held, first = [], bytearray(), self.normalise.dummy or self.normalise.trim

        def flush() -> None:
            while held:
                try:
                    out.append(held.decode())
                    held.clear()
                except UnicodeDecodeError as e:
                    out.append(held[:e.start].decode() + "�")
                    del held[:e.start + 1]
        for number in ids:
            if self.kinds[number] == BYTE:
                held.append(self.byte_values[number])
                first = False
                continue
            flush()
            if self.kinds[number] == CONTROL:
                continue
            if self.kinds[number] == UNKNOWN:
                out.append(self.unknown_text)
                first = False
                continue
            piece = self.texts[number]
            if first and piece.startswith(BLANK):
                piece = piece[1:]
                first = self.normalise.trim and not piece
            else:
                first = False
            out.append(piece.replace(BLANK, " "))
        flush()
        return "".join(out)


class Merger:
    """Merges many words at once. Words are rows of symbols; each step joins, in every row that still has a known pair, the
    neighbours with the best score, the first of equal ones. Pairs of symbols are looked up in a hash table."""

    def __init__(self, model: Model):
        texts = list(dict.fromkeys([*model.scores, *(c for t in model.scores for c in t)]))
        self.number = {t: i for i, t in enumerate(texts)}
        self.model, self.texts = model, texts
        self._describe()
        self.symbols = np.full(0x110000, -1, np.int32)
        for t, i in self.number.items():
            if len(t) == 1:
                self.symbols[ord(t)] = i
        pairs = [(self.number[t[:k]], self.number[t[k:]], i, model.scores[t]) for t, i in self.number.items()
                 if t in model.scores for k in range(1, len(t)) if t[:k] in self.number and t[k:] in self.number]
        self.slots = 1 << max(10, (8 * len(pairs)).bit_length())
        self.keys = np.full(self.slots, -1, np.int64)
        self.to, self.score = np.full(self.slots, -1, np.int32), np.full(self.slots, LOWEST)
        left = np.arange(len(pairs))
        a, b, to, score = (np.array([p[k] for p in pairs]) for k in range(4))
        keys = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = self._slot(keys)
        while len(left):
            free = left[self.keys[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.to[at[put]], self.score[at[put]] = keys[put], to[put], score[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & (self.slots - 1)

    def _describe(self) -> None:
        """What each symbol stands for: its ids as text, their number, the source bytes of each, and what they decode to. A
        character that is no piece is its bytes."""
        m, labels, counts, sizes, back = self.model, [], [], [], []
        for t in self.texts:
            if t in m.ids:
                labels.append(str(m.ids[t]))
                counts.append(1)
                sizes.append(len(t.replace(BLANK, " ").encode()))
                back.append(m.texts[m.ids[t]].replace(BLANK, " "))
            else:
                labels.append(",".join(str(m.bytes[b]) for b in t.encode()) if m.bytes else "")
                counts.append(len(t.encode()))
                sizes.append(1)
                back.append(t)
        self.labels, self.back = pa.array(labels, pa.string()), pa.array(back, pa.string())
        self.counts, self.sizes = np.array(counts), np.array(sizes, np.uint8)

    def _meet(self, characters: np.ndarray) -> None:
        """New symbols for characters of which the model has no piece; they join with nothing."""
        new = np.unique(characters[self.symbols[characters] < 0])
        if len(new):
            self.symbols[new] = np.arange(len(self.texts), len(self.texts) + len(new))
            self.texts += [chr(c) for c in new]
            self._describe()

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) & np.uint64(self.slots - 1)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol that two symbols make, and its score; the lowest where they make none."""
        keys = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = self._slot(keys)
        left = np.flatnonzero((a >= 0) & (b >= 0))
        to, score = np.full(len(keys), -1, np.int32), np.full(len(keys), LOWEST)
        while len(left):
            found = self.keys[at[left]]
            same = left[found == keys[left]]
            to[same], score[same] = self.to[at[same]], self.score[at[same]]
            left = left[(found >= 0) & (found != keys[left])]
            at[left] = (at[left] + 1) & (self.slots - 1)
        return to, score

    def merge(self, words: list[str]) -> list[tuple[str, bytes, str]]:
        """Each word's ids as text, the source bytes of each piece, and the text the ids decode to."""
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max())
        rows = np.full((len(words), width + 1), -1, np.int32)
        characters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self._meet(characters)
        rows[np.arange(width + 1)[None, :] < sizes[:, None]] = self.symbols[characters]
        flat, cuts = self._merged(rows, width)
        lists = lambda names: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), names.take(pa.array(flat)))
        ids, back = (pc.binary_join(lists(names), between).to_pylist() for names, between in ((self.labels, ","), (self.back, "")))
        covered = np.repeat(self.sizes[flat], self.counts[flat]).tobytes()
        ends = np.append(0, np.cumsum(self.counts[flat]))[cuts].tolist()
        return [(i, covered[a:b], t[1:]) for i, a, b, t in zip(ids, ends, ends[1:], back)]

    def _merged(self, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that are left of all rows, one row after another, and the cuts between rows."""
        out = rows.copy()
        live = np.arange(len(rows))
        to, score = (x.reshape(len(live), width) for x in self.pair(rows[:, :-1].ravel(), rows[:, 1:].ravel()))
        columns = np.arange(width)
        while len(live):
            at = score.argmax(axis=1)
            on = score[np.arange(len(live)), at] > LOWEST
            if not on.all():
                out[live[~on]] = rows[~on]
                live, rows, to, score, at = live[on], rows[on], to[on], score[on], at[on]
                if not len(live):
                    break
            line = np.arange(len(live))
            rows[line, at] = to[line, at]
            behind = columns[None, :] > at[:, None]  # everything behind the second of the two moves up
            rows[:, :-1] = np.where(behind, np.append(rows[:, 1:], np.full((len(live), 1), -1, np.int32), axis=1)[:, :-1], rows[:, :-1])
            rows[:, -1] = -1
            later = columns[None, :] >= at[:, None]
            to = np.where(later, np.append(to[:, 1:], np.full((len(live), 1), -1, np.int32), axis=1), to)
            score = np.where(later, np.append(score[:, 1:], np.full((len(live), 1), LOWEST), axis=1), score)
            for place in (at - 1, at):
                ok = np.flatnonzero(place >= 0)
                p = place[ok]
                to[ok, p], score[ok, p] = self.pair(rows[ok, p], rows[ok, p + 1])
        return out[out >= 0], np.append(0, np.cumsum((out >= 0).sum(axis=1)))


class Coder:
    """A model with the words it has seen lately: their ids as text, the source bytes of each piece, as if a blank came
    before them, and the text that the ids decode to. Two generations of words are held, the older one being dropped."""

    def __init__(self, model: Model):
        self.model, self.seen, self.older = model, {}, {}
        n = model.normalise
        self.quick = model.by_word and n.plain and n.escape and n.dummy and BLANK in model.ids
        self.merger = Merger(model) if self.quick and not model.unused and model.bytes else None

    def words(self, text: str) -> list[str] | None:
        """The words of a text; none if it has to be encoded as a whole."""
        if not text or not self.quick or BLANK in text:
            return None
        if "  " in text or text[0] == " ":  # chunks with several blanks
            return [c[1:] for c in self.model.chunks(BLANK + text.replace(" ", BLANK))]
        return text.split(" ")

    def learn(self, lists: list[list[str] | None]) -> None:
        """Merges the words of some texts that are not known yet, each once."""
        if self.merger is None:
            return
        new: set[str] = set()
        for words in lists:
            new.update(words or ())
        new = {w for w in new if w not in self.seen and len(w) < SHORT}
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen, self.older = {}, self.seen
        again = [w for w in new if w in self.older]
        self.seen.update(zip(again, map(self.older.get, again)))
        ordered = sorted(new.difference(again), key=len)
        for at in range(0, len(ordered), AT_ONCE):
            words = ordered[at:at + AT_ONCE]
            self.seen.update(zip(words, self.merger.merge([BLANK + w for w in words])))

    def word(self, word: str) -> tuple[str, bytes, str]:
        found = self.older.get(word)
        if found is None:
            m, chunk = self.model, BLANK + word
            pieces = m.merge(chunk)
            numbers = [m.ids.get(p) for p in pieces]
            if None in numbers:  # with bytes, decoded behind some other piece
                numbers = [i for i, _ in m.piece_ids([p.replace(BLANK, " ") if p not in m.ids else p for p in pieces])]
                sizes = [len(m.texts[i].replace(BLANK, " ").encode()) if m.kinds[i] != BYTE else 1 for i in numbers]
            else:
                sizes = map(len, pieces) if word.isascii() else [len(p.replace(BLANK, " ").encode()) for p in pieces]
            # behind some other piece, as a text's first blank is dropped
            found = ",".join(map(str, numbers)), bytes(sizes), m.decode([m.ids[BLANK], *numbers])[1:]
        if len(word) < 64:
            if len(self.seen) >= REMEMBERED:
                self.seen, self.older = {}, self.seen
            self.seen[word] = found
        return found

    def __call__(self, text: str, words: list[str] | None = None) -> tuple[str, int, str, np.ndarray]:
        """Ids joined by commas, their number, the text they decode to, and the source byte at which each
        piece ends; a piece begins where the one before it ends."""
        words = self.words(text) if words is None else words
        if words is None:
            m = self.model
            ids, spans = m.encode(text)
            return ",".join(map(str, ids)), len(ids), m.decode(ids), np.array([e for _, e in spans], np.int64)
        seen = self.seen
        found = [seen.get(w) or self.word(w) for w in words]
        ids, sizes = ",".join([f[0] for f in found]), b"".join([f[1] for f in found])
        # the first piece loses its blank, which no source byte made
        ends = np.cumsum(np.frombuffer(sizes, np.uint8), dtype=np.int64) - 1
        return ids, len(sizes), " ".join([f[2] for f in found]), ends

    def all(self, column: pa.Array) -> Iterator[tuple[str, int, str, np.ndarray]]:
        """The texts of a column, in blocks whose new words are merged together."""
        for at in range(0, len(column), BLOCK_ROWS):
            texts = [t or "" for t in column.slice(at, BLOCK_ROWS).to_pylist()]
            lists = [self.words(t) for t in texts]
            self.learn(lists)
            for text, words in zip(texts, lists):
                yield self(text, words)


def digests(path: str, text: str = "text", keep: bool = True) -> F.Column:
    """A struct about whole texts (with `keep` a worker remembers words from task to task, which is faster and
    holds some 60 MB for as long as the worker lives): `n_tokens`, `ids_sha256`, `decoded_sha256`, and `spans_sha256`, the hash of
    the 64-bit little-endian source bytes at which the pieces end."""
    names = ("n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256")
    kind = pa.struct([(n, pa.string() if k else pa.int64()) for k, n in enumerate(names)])

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = worker_cache(("model", path), lambda: Model(path))
        coder = worker_cache(("coder", path), lambda: Coder(model)) if keep else Coder(model)

        def digest(ids: str, count: int, back: str, ends: np.ndarray) -> tuple[int, str, str, str]:
            return (count, *(hashlib.sha256(x).hexdigest() for x in (ids.encode(), back.encode(), ends.tobytes())))
        for column in columns:
            found = [digest(*f) for f in coder.all(column)]
            yield pa.StructArray.from_arrays([pa.array([f[k] for f in found], kind[k].type) for k in range(4)],
                                             fields=list(kind))
    return apply(F.col(text))


def encoded(path: str, text: str = "text", keep: bool = True) -> F.Column:
    """What `digests` gives, and the ids and spans themselves: arrays `ids` and `ends`, the source byte at which each piece
    ends. A piece begins where the one before it ends, the first at 0."""
    plain = [("n_tokens", pa.int64()), *[(n, pa.string()) for n in ("ids_sha256", "decoded_sha256", "spans_sha256")]]
    lists = [(n, pa.list_(pa.int32())) for n in ("ids", "ends")]

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string, ids array<int>, ends array<int>")
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = worker_cache(("model", path), lambda: Model(path))
        coder = worker_cache(("coder", path), lambda: Coder(model)) if keep else Coder(model)
        for column in columns:
            rows, ids, ends = [], [], []
            for joined, count, back, to in coder.all(column):
                rows.append((count, *(hashlib.sha256(x).hexdigest() for x in (joined.encode(), back.encode(), to.tobytes()))))
                ids.append(np.fromstring(joined, np.int32, sep=",") if joined else np.zeros(0, np.int32))
                ends.append(to.astype(np.int32))
            cuts = pa.array(np.cumsum([0, *map(len, ends)]), pa.int32())
            arrays = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(plain)]
            arrays += [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([np.zeros(0, np.int32), *parts]))) for parts in (ids, ends)]
            yield pa.StructArray.from_arrays(arrays, fields=[pa.field(*c) for c in plain + lists])
    return apply(F.col(text))


def decoded(path: str, ids: str = "ids") -> F.Column:
    """The text of an array of ids; null for null."""
    @F.arrow_udf("string")
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = worker_cache(("model", path), lambda: Model(path))
        for column in columns:
            yield pa.array([None if x is None else model.decode(x) for x in column.to_pylist()], pa.string())
    return apply(F.col(ids))
