"""SentencePiece models on the tokenizers library.

The model file's protobuf is read here; from it come the vocabulary with its scores, the
normaliser, the space marker and the byte fallback.  A unigram model becomes the library's unigram
model with those scores; a BPE model becomes its BPE model, whose merges are every way to part a
piece into two pieces, in the order of the scores.  Texts are encoded in batches on several threads.
The pieces between single spaces are encoded once for each worker and, the first time, compared
with what sentencepiece itself gives for them: many of them in one line, which is parted at the
marker that each brings, and one by one if anything in the line differs.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import strings
from .shared import small_batches

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
THREADS = 2
#: The longest piece that is remembered.
LONG = 128
#: Pieces in a line; pieces and bytes that a generation of the cache may take, and an entry's own cost.
LINE, GENERATION, CACHE_BYTES, ENTRY_BYTES = 128, 400_000, 96 << 20, 200


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: varints as numbers, the rest as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) if kind != 2 else varint()
        if size is None:
            raise ValueError(f"not a SentencePiece model: wire type {kind}")
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Spec:
    """What a model file says; the defaults are the format's."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse(data: bytes) -> Spec:
    spec = Spec()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    (score,) = struct.unpack("<f", v)
                elif n == 3:
                    kind = v
            spec.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    spec.kind = v
                elif n == 35:
                    spec.byte_fallback = bool(v)
                elif n == 40:
                    spec.unk_id = v
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    spec.charsmap = v
                elif n == 3:
                    spec.dummy_prefix = bool(v)
                elif n == 4:
                    spec.squeeze = bool(v)
                elif n == 5:
                    spec.escape = bool(v)
    return spec


def merges(spec: Spec) -> list[tuple[str, str]]:
    """Every pair of pieces that makes a piece, best score first; of one piece, the pairs of the best parts first."""
    rank = {p: (-s, i) for i, (p, s, k) in enumerate(spec.pieces) if k in (NORMAL, USER)}
    found = []
    for piece, place in rank.items():
        for cut in range(1, len(piece)):
            a, b = piece[:cut], piece[cut:]
            if a in rank and b in rank:
                found.append((place, rank[a][1], rank[b][1], (a, b)))
    return [pair for *_, pair in sorted(found)]


def build(spec: Spec):
    """The same tokenizer in the tokenizers library."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if spec.kind == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in spec.pieces], unk_id=spec.unk_id, byte_fallback=spec.byte_fallback)
    elif spec.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(spec.pieces)}
        model = models.BPE(vocab, merges(spec), unk_token=spec.pieces[spec.unk_id][0], fuse_unk=True, byte_fallback=spec.byte_fallback)
    else:
        raise ValueError("word and character models have no counterpart")
    tokenizer = Tokenizer(model)
    steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
    if spec.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(" ")] if spec.dummy_prefix else []
    steps += [normalizers.Replace(" ", MARK)] if spec.escape else []
    tokenizer.normalizer = normalizers.Sequence(steps)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(back + ([decoders.Strip(" ", 1, 0)] if spec.dummy_prefix else []))
    return tokenizer


class Bridge:
    """Encodes and decodes texts; ``odd`` holds the pieces whose ids differ from sentencepiece's."""

    def __init__(self, path: str, threads: int = THREADS, generation: int = GENERATION, verify: bool = True, cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        with open(path, "rb") as f:
            self.spec = parse(f.read())
        self.tokenizer = build(self.spec)
        self.origin = None
        if verify:
            import sentencepiece

            self.origin = sentencepiece.SentencePieceProcessor(model_file=path)
        #: Cutting at a space is safe if every word gets the marker alike and no piece reaches over one.
        self.parts = self.spec.dummy_prefix and self.spec.escape and not self.spec.charsmap and not any(
            MARK in p.lstrip(MARK) for p, _, k in self.spec.pieces if k in (NORMAL, USER))
        #: Whether a piece begins with the marker, by id; no piece has another one if pieces can share a line.
        self.begins = np.array([p.startswith(MARK) for p, _, _ in self.spec.pieces])
        self.threads, self.generation, self.cache_bytes = threads, generation, cache_bytes
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.spent = 0
        #: Pieces whose ids are not sentencepiece's, and pieces that decoding does not give back.
        self.odd: set[str] = set()
        self.lost: set[str] = set()

    def _checked(self, block: list[str]) -> list[bytes]:
        """Ids of the pieces; each is held against sentencepiece's own ids, and decoded again."""
        found = self.tokenizer.encode_batch_fast(block, add_special_tokens=False)
        ids = [e.ids for e in found]
        if self.origin:
            self.odd.update(p for p, a, b in zip(block, ids, self.origin.encode(block, num_threads=self.threads)) if a != b)
        squeeze = (lambda t: " ".join(x for x in t.split(" ") if x)) if self.spec.squeeze else (lambda t: t)
        self.lost.update(p for p, d in zip(block, self.decode(ids)) if squeeze(p) != d)
        return [array("I", x).tobytes() for x in ids]

    def _lines(self, block: list[str]) -> list[bytes]:
        """The same as ``_checked`` for pieces between spaces, from whole lines of them.

        Each piece of a line brings one marker and no id reaches over it, so a line whose ids and decoded text are
        right has only right pieces, and as many ids that begin with the marker as pieces; else each is checked alone.
        """
        if self.spec.squeeze or self.spec.kind != BPE:  # a line's ends would be stripped; sums of scores depend on what stands before
            return self._checked(block)
        runs = [block[at : at + LINE] for at in range(0, len(block), LINE)]
        lines = [" ".join(run) for run in runs]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        theirs = self.origin.encode(lines, num_threads=self.threads) if self.origin else ids
        out: list[bytes] = []
        for run, line, own, other, back in zip(runs, lines, ids, theirs, self.decode(ids)):
            row = np.array(own, "<u4")
            at = (np.flatnonzero(self.begins[row]) * 4).tolist()
            if own != other or back != line or len(at) != len(run) or not all(run):
                out += self._checked(run)
                continue
            raw = row.tobytes()
            out += [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)])]
        return out

    def _learn(self, wanted: set[str]) -> None:
        if len(self.young) > self.generation or self.spent > self.cache_bytes:
            self.old, self.young, self.spent = self.young, {}, 0
            self.odd = {p for p in self.odd if p in self.old}
            self.lost = {p for p in self.lost if p in self.old}
        new = wanted - self.young.keys()
        again = new & self.old.keys()
        self.young.update((p, self.old[p]) for p in again)
        names = list(new - again)
        for at in range(0, len(names), 8192):
            block = names[at : at + 8192]
            self.young.update(zip(block, self._lines(block)))
        self.spent += sum(ENTRY_BYTES + len(p) + len(self.young[p]) for p in new)

    def encode(self, texts: Iterable[str | None], block_chars: int = 2_000_000) -> Iterator[tuple[bytes, bool, bool]]:
        """For each text (None counts as empty) its ids as uint32 bytes, whether they are sentencepiece's, and whether
        decoding them gives the text back (up to the white space that the model's normaliser drops).

        A text whose pieces between single spaces stand alone is judged by its pieces: the ids, and what
        they decode to, are those of the pieces one after another.
        """
        block, chars = [], 0
        for text in texts:
            block.append(text or "")
            chars += len(block[-1])
            if chars >= block_chars:
                yield from self._block(block)
                block, chars = [], 0
        yield from self._block(block)

    def _block(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        safe = [self.parts and t[:1] != " " and t[-1:] != " " and "  " not in t and MARK not in t for t in texts]
        parts = [t.split(" ") if s else None for t, s in zip(texts, safe)]
        parts = [p if p and max(map(len, p)) <= LONG else None for p in parts]
        self._learn(set().union(*(p for p in parts if p)))
        at, out = self.young.__getitem__, []
        for text, p in zip(texts, parts):
            raw = b"".join(map(at, p)) if p else self._checked([text])[0]
            held = p or [text]
            out.append((raw, not self.odd or self.odd.isdisjoint(held), not self.lost or self.lost.isdisjoint(held)))
            if not p:  # whole texts are not remembered
                self.odd.discard(text)
                self.lost.discard(text)
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


_BRIDGES: dict[str, Bridge] = {}


def bridge(path: str) -> Bridge:
    if path not in _BRIDGES:
        _BRIDGES[path] = Bridge(path)
    return _BRIDGES[path]


def encode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_crc32, parity (ids equal sentencepiece's),
    round_trip (decoding gives the text back, up to the white space that the model's normaliser drops), and
    ids (uint32 bytes) if asked for.

    A null text is empty and has no ids.  Nothing is shuffled; rows of any number and order are
    encoded on their own, other columns are ignored, and an empty table gives no rows.
    """

    kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("parity", pa.bool_()), ("round_trip", pa.bool_())]
    schema = pa.schema(kinds + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bridge(path)
        for batch in batches:
            out = [(len(raw) // 4, zlib.crc32(raw), same, back, raw) for raw, same, back in b.encode(strings(batch.column("text")))]
            columns = [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(zip(*out), list(schema)[1:]))]
            if out:
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    small_batches(docs.sparkSession)
    names = "doc_id long, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, names)
