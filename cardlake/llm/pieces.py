"""SentencePiece encoding and decoding by streaming Viterbi.

The vocabulary comes from a public model file (path is a parameter).  A text
is cut into the pieces of largest total score.  The file of a merge-based
vocabulary orders its pieces by rank and has no log probabilities, so a piece
of rank r scores ``-ln(r + 2)`` (Zipf's law), held as an integer of millionths
so that sums are exact in any order.  Characters that no piece covers become
byte pieces, which score below every other piece; of equally good cuts the
one with the longest last piece wins.  No dummy space is put before a text
and nothing is normalised, hence decoding gives back the exact text.

``StreamingViterbi`` reads characters and keeps a window: the open boundaries
(no piece is longer than ``max_len``, so there are that many at most) and the
backpointers that are not committed yet.  Whenever the surviving backpointer
paths of all open boundaries meet in one boundary, the ids up to it are
committed and everything before it goes.

In bulk, texts are fed between boundaries that no piece can span (before a
run of spaces, around a line end, between a letter and a punctuation mark, as
far as the vocabulary has no piece across): all
paths meet there at once, so the committed ids of a short stretch don't depend
on what surrounds it and may be remembered: in two tables of bounded size that
end with the task.  When the younger one is full the older one goes, so what
occurs often stays.  Results leave in batches of bounded size as well.

Defined cases: a null text counts as empty and has no ids; very long texts and
texts without any space are streamed; repeated rows and extra columns pass
through; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CACHE_ENTRIES = 1 << 17  # stretches in each of the two tables
CACHE_CHARS = 48         # of the longest stretch remembered
BATCH_CHARS = 1 << 20    # characters of text that one batch of results stands for, or one text
CHUNK = 512  # characters taken into the window at a time
LOWEST = -(1 << 62)  # below any score of a path


@dataclass(frozen=True)
class Vocabulary:
    """Bounded tables of a model file: what encoding and decoding need."""

    pieces: dict[str, tuple[int, tuple[int]]]  # piece with plain spaces -> (score, (id,))
    # the same as a tree of characters: character -> (what follows it, its pieces' entry or None)
    tree: dict
    byte_ids: tuple[int, ...]           # id of each of the 256 byte pieces
    byte_score: int                     # score of one byte piece
    table: tuple[bytes, ...]            # id -> bytes that it stands for
    max_len: int                        # characters of the longest piece
    stretch: str                        # pattern of a stretch between sure boundaries


def load_vocabulary(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a SentencePiece model file on the driver; tasks get the tables."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i)
                                    or model.is_byte(i) or model.is_unused(i))]
    text = {i: model.id_to_piece(i).replace("▁", " ") for i in plain}
    ranked = sorted(plain, key=lambda i: (-model.get_score(i), i))
    pieces = {text[i]: (-round(1e6 * math.log(r + 2)), (i,)) for r, i in enumerate(ranked)}
    tree: dict = {}
    for piece, entry in pieces.items():
        node = tree
        for c in piece[:-1]:
            node = node.setdefault(c, ({}, None))[0]
        node[piece[-1]] = (node.get(piece[-1], ({}, None))[0], entry)
    byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary has no byte pieces; exact decoding needs them")
    table = [text[i].encode() if i in text else b"" for i in ids]
    for value, i in byte_ids.items():
        table[i] = bytes([value])
    # a stretch may end before a run of spaces, around a line end, and between a letter and
    # a mark, unless a piece goes across
    space = not any(re.search(r"[^ ] ", p) for p in pieces)
    line = not any("\n" in p and len(p) > 1 for p in pieces)
    across = {c for p in pieces for c in re.findall(r"(?<=[^\W\d_])[,.!?;:]", p)}
    marks = "".join(c for c in ",.!?;:" if c not in across)
    stretch = {(True, True): r"\n| *[^ \n]+| +", (True, False): r" *[^ ]+| +",
               (False, True): r"\n|[^\n]+", (False, False): r"(?s).+"}[space, line]
    if marks:
        stretch = rf"{' *+' if space else ''}[^\W\d_]++(?=[{marks}])|{stretch}"
    return Vocabulary(pieces, tree, tuple(byte_ids[b] for b in range(256)),
                      -round(2e6 * math.log(len(ranked) + 2)), tuple(table),
                      max(map(len, text.values())), stretch)


class StreamingViterbi:
    """Feed text in any chunks; ``feed`` and ``finish`` return the ids committed so far."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text = ""        # read and not committed; the lists are indexed by its boundaries
        self.at = 0           # boundary whose pieces are looked up next
        self.score = [0]      # best score of a path to the boundary
        self.back = [0]       # previous boundary on that path
        self.step = [()]      # ids of the last piece on it
        self.most = 0         # the most characters ever held back

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        for i in range(0, len(text), CHUNK):
            out += self._read(text[i:i + CHUNK])
        return out

    def _read(self, text: str, last: bool = False) -> list[int]:
        root, pieces, max_len = self.v.tree, self.v.pieces, self.v.max_len
        score, back, step = self.score, self.back, self.step
        out: list[int] = []
        text = self.text + text
        n, at = len(text), self.at
        grow = n + 1 - len(score)
        score += [LOWEST] * grow
        back += [0] * grow
        step += [()] * grow
        # a piece from boundary i may end max_len further on, so that much must be read
        stop = n if last else n - max_len + 1
        while at < stop:
            base, end, node = score[at], at, root
            for c in text[at:at + max_len]:
                if c not in node:
                    break
                node, entry = node[c]
                end += 1
                if entry is not None:
                    total = base + entry[0]
                    if total > score[end]:
                        score[end] = total
                        back[end] = at
                        step[end] = entry[1]
            if text[at] not in pieces:
                raw = text[at].encode("utf-8", "surrogatepass")
                total = base + self.v.byte_score * len(raw)
                if total > score[at + 1]:
                    score[at + 1], back[at + 1] = total, at
                    step[at + 1] = tuple(self.v.byte_ids[b] for b in raw)
            at += 1
            if at % max_len == 0 and at < stop:
                done = self._meeting(at, min(n, at + max_len - 1))
                if done:
                    out += self._commit(done)
                    text = text[done:]
                    n, at, stop = n - done, at - done, stop - done
                self.most = max(self.most, at + max_len)
        self.text, self.at = text, at
        return out

    def finish(self, text: str = "") -> list[int]:
        """The rest of the ids, of ``text`` too; the stream is then as new."""
        out = self.feed(text[:-CHUNK]) if len(text) > CHUNK else []
        out += self._read(text[-CHUNK:], last=True)
        ids, at = [], len(self.text)
        while at:
            ids.append(self.step[at])
            at = self.back[at]
        for piece in reversed(ids):
            out += piece
        self.text, self.at, self.score, self.back, self.step = "", 0, [0], [0], [()]
        return out

    def _meeting(self, first: int, last: int) -> int:
        """The last boundary on the paths of all boundaries that are still open."""
        live = {i for i in range(first, last + 1) if self.score[i] > LOWEST}
        while len(live) > 1:
            live.add(self.back[live_max := max(live)])
            live.remove(live_max)
        return live.pop()

    def _commit(self, boundary: int) -> list[int]:
        """Ids up to the boundary; drops all that is held of it."""
        steps, at = [], boundary
        while at:
            steps.append(self.step[at])
            at = self.back[at]
        base = self.score[boundary]  # only differences matter from here on
        self.score[:] = [x if x == LOWEST else x - base for x in self.score[boundary:]]
        self.back[:] = [max(0, x - boundary) for x in self.back[boundary:]]
        del self.step[:boundary]
        return [i for ids in reversed(steps) for i in ids]


class Encoder:
    """Text to ids and back, inside a task."""

    def __init__(self, vocabulary: Vocabulary, cache_entries: int = CACHE_ENTRIES):
        self.v, self.entries = vocabulary, cache_entries
        self.stretches = re.compile(vocabulary.stretch).findall
        self.known: dict[str, array] = {}
        self.older: dict[str, array] = {}
        self.stream = StreamingViterbi(vocabulary)
        self.blob = np.frombuffer(b"".join(vocabulary.table), np.uint8)
        self.size = np.array([len(b) for b in vocabulary.table])
        self.place = np.cumsum(self.size) - self.size

    def stretch(self, text: str) -> array:
        """Ids of a stretch that the younger table doesn't have."""
        ids = self.older.get(text) or array("i", self.stream.finish(text))
        if len(text) <= CACHE_CHARS:
            if len(self.known) >= self.entries:
                self.known, self.older = {}, self.known
            self.known[text] = ids
        return ids

    def encode(self, text: str, into: array | None = None) -> array:
        out = array("i") if into is None else into
        add = out.extend
        for part in self.stretches(text):
            add(self.known.get(part) or self.stretch(part))
        return out

    def decode(self, ids) -> str:
        """The bytes of the pieces one after the other, gathered from one blob of all pieces."""
        which = np.asarray(ids, np.int32)
        size = self.size[which]
        at = np.repeat(self.place[which] - (np.cumsum(size) - size), size)
        at += np.arange(len(at))
        return self.blob[at].tobytes().decode("utf-8", "surrogatepass")


def with_ids(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids",
             decoded: str | None = None, same: str | None = None,
             columns: list[str] | None = None) -> DataFrame:
    """``df`` (its ``columns``; default all) with ``ids`` (array of int); ``decoded``: the
    text decoded from them; ``same``: whether that equals the text (null: empty)."""
    extra = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    extra += [T.StructField(decoded, T.StringType())] if decoded else []
    extra += [T.StructField(same, T.BooleanType())] if same else []
    names = {f.name for f in extra}
    keep = [c for c in (df.columns if columns is None else columns) if c not in names]
    src = df.select(*keep, *([] if text in keep else [text]))

    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder = Encoder(shared.value)
        for whole in batches:
            for b in _slices(whole, text):
                flat, ends, texts, equal = array("i"), [0], [], []
                for value in b[text]:
                    source = value.as_py() or ""
                    encoder.encode(source, flat)
                    if decoded or same:
                        back = encoder.decode(flat[ends[-1]:])
                        equal.append(back == source)
                        if decoded:
                            texts.append(back)
                    ends.append(len(flat))
                values = pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)])
                made = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)]
                made += [pa.array(texts, pa.string())] if decoded else []
                made += [pa.array(equal, pa.bool_())] if same else []
                yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], *made],
                                                 names=[*keep, *(f.name for f in extra)])

    return src.mapInArrow(run, T.StructType([*[src.schema[c] for c in keep], *extra]))


def _slices(b: pa.RecordBatch, text: str):
    """The batch in slices of BATCH_CHARS characters or one row."""
    length = np.cumsum(pc.fill_null(pc.utf8_length(b[text]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < b.num_rows:
        before = int(length[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(length, before + BATCH_CHARS, "right")))
        yield b.slice(at, end - at)
        at = end
