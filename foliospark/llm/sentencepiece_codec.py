"""Exact SentencePiece BPE encoding by backtracking, and decoding.

A merge-type encoding is the one sequence of pieces in which every two neighbours are
compatible: merging their joint text from its characters gives those two pieces again. The
encoder walks from the left, takes the longest piece in an Aho-Corasick automaton's trie that starts
there, checks it against the piece before, and otherwise tries shorter ones. A position from which
nothing led to the end is marked in a bit field and never tried again, so the work
stays linear in the text. Compatibility is decided by re-merging and remembered per pair.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import ship_code

SPACE = "▁"
#: Entries that a worker remembers of words and of piece pairs before it forgets old ones.
CACHE_ENTRIES = 1_000_000
#: Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class Codec:
    """Encoder and decoder of one model file: BPE, identity normalizer, byte fallback."""

    def __init__(self, model: bytes, cache_entries: int = CACHE_ENTRIES):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if (
            trainer.model_type != 2
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or not norm.escape_whitespaces
            or not trainer.byte_fallback
            or kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        ):
            raise ValueError("not a BPE model with identity normalizer and byte fallback")
        self.score = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        byte_ids = [i for i, p in enumerate(proto.pieces) if p.type == _BYTE]
        self.byte_id = {int(proto.pieces[i].piece[1:-1], 16): i for i in byte_ids}
        self.surface: list[bytes] = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == _BYTE
            else b"" if p.type == _CONTROL
            else b" \xe2\x81\x87 " if p.type == _UNKNOWN
            else p.piece.replace(SPACE, " ").encode()
            for p in proto.pieces
        ]
        self.is_byte = [p.type == _BYTE for p in proto.pieces]
        self.skipped = {i for i, p in enumerate(proto.pieces) if p.type in (_CONTROL,)}
        self.decimal = [str(i) for i in range(len(proto.pieces))]
        self.surface_of = dict(zip(self.decimal, self.surface))
        # units: space marks with the letters, or the other characters, that follow them
        word_chars = {c for p in self.ids for c in p if re.match(r"[^\W\d_]", c)}
        odd = re.escape("".join(sorted(c for c in word_chars if not c.isalpha())))
        self.unit = re.compile(
            f"{SPACE}*[^\\W\\d_{odd}]+|{SPACE}*(?:[\\d_{odd}]|[^\\w{SPACE}])+|{SPACE}+"
        )
        self.by_unit = all(self.unit.fullmatch(p) for p in self.ids)
        # only pieces that their own text merges to can occur, and characters of no piece
        reachable = {p for p in self.ids if len(p) == 1 or self.merged(p) == [p]}
        self.trie = ahocorasick.Automaton()
        for p in reachable:
            self.trie.add_word(p, len(p))
        self.trie.make_automaton()
        self.longest_piece = max(map(len, reachable))
        # length of the next shorter piece that begins a piece; every character may stand alone
        self.shorter = {
            p: next((k for k in range(len(p) - 1, 1, -1) if p[:k] in reachable), len(p) > 1)
            for p in reachable
        }
        self.limit = cache_entries
        self.words: dict[str, str] = {}
        self.older_words: dict[str, str] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces by merging from single characters: best score first, then leftmost."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            joint = parts[i] + parts[j]
            if joint in self.score:
                heapq.heappush(heap, (-self.score[joint], i, joint))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, joint = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != joint:
                continue
            parts[i], parts[j] = joint, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]

    def compatible(self, left: str, right: str) -> bool:
        """Do the two pieces stay as they are when their joint text is merged?"""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= self.limit:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return known

    def backtracked(self, text: str) -> list[str]:
        """The pieces of `text`; a character of no piece is one of its own."""
        pieces: list[str] = []
        n, last, at, length = len(text), None, 0, 0
        shorter, pairs, prefix, most = self.shorter, self.pairs, self.trie.longest_prefix, self.longest_piece
        failed = 0  # bit i: no encoding goes on from position i
        while at < n:
            if not length:  # a new position: the longest piece that starts here
                length = prefix(text[at : at + most]) or 1
                while length > 1 and text[at : at + length] not in shorter:
                    length -= 1
            piece = text[at : at + length]
            if not (failed and failed >> (at + length) & 1):
                fits = True if last is None else pairs.get((last, piece))
                if fits is None:
                    fits = self.compatible(last, piece)
                if fits:
                    pieces.append(piece)
                    at += length
                    length, last = 0, piece
                    continue
            length = shorter.get(piece, 0)
            while not length:
                # nothing fits here: give up this position and shorten the piece before
                failed |= 1 << at
                piece = pieces.pop()
                last = pieces[-1] if pieces else None
                at -= len(piece)
                length = shorter.get(piece, 0)
        return pieces

    def ids_of(self, unit: str) -> list[int]:
        # runs of marks: their pieces all have the same score, so that the place of a merge
        # depends on more than two neighbours; these few are merged directly
        pieces = self.merged(unit) if SPACE * 2 in unit else self.backtracked(unit)
        ids = [self.ids.get(p) for p in pieces]
        if None in ids:
            bytes_of = lambda p: [self.byte_id[b] for b in p.encode("utf-8", "surrogatepass")]
            ids = [i for p, k in zip(pieces, ids) for i in ([k] if k is not None else bytes_of(p))]
        return ids

    def units(self, text: str) -> list[str]:
        """Parts that are encoded on their own, because no piece reaches from one to the next."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return self.unit.findall(marked) if self.by_unit else [marked]

    def _known(self, unit: str) -> str:
        known = self.older_words.get(unit)
        if known is None:
            known = ",".join([self.decimal[i] for i in self.ids_of(unit)])
        if len(unit) <= 64:
            if len(self.words) >= self.limit // 2:
                self.older_words, self.words = self.words, {}
            self.words[unit] = known
        return known

    def encode(self, text: str) -> list[int]:
        return [i for unit in self.units(text) for i in self.ids_of(unit)]

    def decode(self, ids: list[int]) -> str:
        """Text of `ids`: byte pieces are joined, invalid bytes each become U+FFFD, and the one
        space that encoding put in front is taken away."""
        raw = b"".join([self.surface[i] for i in ids])
        lead = next((i for i in ids if i not in self.skipped), None)
        if lead is not None and not self.is_byte[lead] and raw[:1] == b" " and lead in self._marked:
            raw = raw[1:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return _each_invalid_byte(raw)

    @property
    def _marked(self) -> set[int]:
        if not hasattr(self, "_marked_ids"):
            self._marked_ids = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        return self._marked_ids

    def round_trip(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, digest of the ids and digest of the text decoded from them."""
        known = self.words.get
        joined = ",".join([known(u) or self._known(u) for u in self.units(text or "")])
        ids = joined.split(",") if joined else []
        raw = b"".join(map(self.surface_of.__getitem__, ids))
        if raw[:1] == b" ":  # the text's own bytes come back: only the mark in front goes
            raw = raw[1:]
        digest = hashlib.sha256
        return len(ids), digest(joined.encode()).hexdigest(), digest(raw).hexdigest()


def _each_invalid_byte(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode("utf-8") + "�")
            at += e.start + 1
    return "".join(out)


_MADE: dict[tuple[bytes, int], Codec] = {}


def _codecs(model: bytes, cache_entries: int):
    """The codec of a worker process, which serves all tasks it runs one after another."""
    key = (hashlib.sha256(model).digest(), cache_entries)

    def get() -> Codec:
        if key not in _MADE:
            _MADE.clear()
            _MADE[key] = Codec(model, cache_entries)
        return _MADE[key]

    return get


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str, cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """(doc_id, ids): ids of the whole text of each row; null and empty texts have none."""
    codec = _codecs(_model(model_path), cache_entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [codec().encode(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    ship_code(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode(rows: DataFrame, model_path: str, cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""
    codec = _codecs(_model(model_path), cache_entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [codec().decode(i.as_py() or []) for i in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    ship_code(rows)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, text string"
    )


def round_trip(docs: DataFrame, model_path: str, cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """One row per row: doc_id, n_tokens, ids_sha256, decoded_sha256, in one pass.

    The digests are of the decimal ids joined by commas and of the text decoded from the
    ids. Null texts count as empty (no ids, digests of nothing). Repeated rows stay; other
    columns are not read; an empty table gives no rows. The model is read on the driver and
    goes to the workers with the function; each keeps at most `cache_entries` words of up to
    64 characters, whatever the text holds.
    """
    codec = _codecs(_model(model_path), cache_entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [codec().round_trip(t.as_py()) for t in b.column(1)]
            counts, ids, texts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    ship_code(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
