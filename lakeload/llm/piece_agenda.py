"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs that form a piece, ordered by
the piece's score and then by place: the best pair is merged, its new neighbours
join the agenda, until no pair is left. Symbols that are no piece become UTF-8
byte pieces. No merge crosses a place where no piece can lie (before a space mark
that follows other characters, around characters of no longer piece), so a text is
cut there and the ids of a section are remembered per worker; the agendas of short
new sections advance together, one merge each a round. Every Arrow batch is
compared with the sentencepiece library, ids and decoded text; a difference is an
error that names the document.

Edge cases: a null or empty text has the end id alone and decodes to the empty
text; a null ``doc_id`` is carried along; rows that repeat are encoded each for
itself; the space mark itself (U+2581) in a text decodes to a space, as in the
library; an empty table gives no rows. Of the input only ``doc_id`` and ``text``
are read, so other columns may have any name.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_MARK = "▁"

#: Sections of one generation. A Python worker remembers two, as texts repeat most of their words.
REMEMBERED = 300_000

#: Sections longer than this are not remembered.
SECTION_CHARS = 64

#: UTF-8 bytes of text that are encoded and checked at a time.
SLICE_BYTES = 2_000_000

#: Rank of a pair that is no piece.
NO_PAIR = 1 << 24

ENCODED = "doc_id long, ids array<int>, decoded string"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def text_slices(texts: list[str], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` characters, one text at least."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


class PieceVocabulary:
    """Pieces, scores and byte ids of a model file, with encoding and decoding."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as schema

        self.library = SentencePieceProcessor(model_file=path)
        model = schema.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kind, spec = schema.ModelProto.SentencePiece, model.normalizer_spec
        plain = not spec.precompiled_charsmap and spec.escape_whitespaces and not spec.remove_extra_whitespaces
        known = {kind.NORMAL, kind.UNKNOWN, kind.CONTROL, kind.BYTE}
        if model.trainer_spec.model_type != schema.TrainerSpec.BPE or not plain or {p.type for p in model.pieces} - known:
            raise ValueError("only merge-type vocabularies without a character map and with plain, control and byte pieces are supported")
        self.prefix = SPACE_MARK if spec.add_dummy_prefix else ""
        self.end_id, self.unknown_id = self.library.eos_id(), self.library.unk_id()
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.shown = [p.piece.replace(SPACE_MARK, " ") if p.type == kind.NORMAL else model.trainer_spec.unk_surface if p.type == kind.UNKNOWN else "" for p in model.pieces]
        self.spaced = {i for piece, i in self.ids.items() if piece.startswith(SPACE_MARK)}
        # A byte below 128 is a character of its own; the others only make sense in runs.
        self.alone = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else None if i in self.byte_of else text for i, text in enumerate(self.shown)]
        # Characters that occur in pieces are symbols too, also where they are no piece.
        self.symbols = dict(self.ids)
        for c in sorted(set("".join(self.ids))):
            self.symbols.setdefault(c, len(model.pieces) + len(self.symbols))
        self.base = len(model.pieces) + len(self.symbols)
        self.merges = self.merge_table({p.piece: p.score for p in model.pieces if p.type == kind.NORMAL})
        # The same as sorted arrays.
        self.pair_keys = np.array(sorted(self.merges), np.int64)
        self.pair_ranks, self.pair_pieces = np.array([self.merges[key] for key in self.pair_keys.tolist()], np.int64).T
        self.symbol_of = np.full(sys.maxunicode + 1, -1, np.int64)
        for c, symbol in self.symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = symbol
        self.sections = self.section_pattern()
        self.by_words = bool(self.prefix) and self.sections.fullmatch(f"{SPACE_MARK}a{SPACE_MARK}") is None
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def merge_table(self, scores: dict[str, float]) -> dict[int, tuple[int, int]]:
        """Pair of symbols -> rank of the piece they make (equal for equal scores), and the piece."""
        ranks = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        table = {}
        for piece, score in scores.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    table[left * self.base + right] = (ranks[score], self.ids[piece])
        return table

    def section_pattern(self) -> re.Pattern:
        """Sections of a text that no piece reaches beyond."""
        longer = [p for p in self.ids if len(p) > 1]
        used = set("".join(longer))
        alone = "".join(re.escape(c) for c in "\n\r\t\x0b\x0c" if c not in used)
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in longer):
            return re.compile(f"[^{alone}]+|[{alone}]" if alone else "(?s:.+)")
        return re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}{alone}]*|[^{SPACE_MARK}{alone}]+" + (f"|[{alone}]" if alone else ""))

    def merged(self, section: str) -> tuple[list[int], list[int]]:
        """Places and symbols that are left when the agenda of adjacent pairs is empty; -1 stands for an unknown character."""
        symbols, merges, base = [self.symbols.get(c, -1) for c in section], self.merges, self.base
        n = len(symbols)
        # An entry is rank * n + place: the best score first, the leftmost of equal ones.
        agenda = [found[0] * n + i for i in range(n - 1) if symbols[i] >= 0 <= symbols[i + 1] and (found := merges.get(symbols[i] * base + symbols[i + 1]))]
        if not agenda:
            return list(range(n)), symbols
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        gone = -2
        while agenda:
            rank, left = divmod(heappop(agenda), n)
            symbol, right = symbols[left], after[left]
            if symbol < 0 or right == n or symbols[right] < 0:
                continue
            found = merges.get(symbol * base + symbols[right])
            if found is None or found[0] != rank:
                continue  # one of the two has changed since
            piece = symbols[left] = found[1]
            symbols[right] = gone
            follower = after[left] = after[right]
            if follower < n:
                before[follower] = left
                if symbols[follower] >= 0 and (found := merges.get(piece * base + symbols[follower])):
                    heappush(agenda, found[0] * n + left)
            leader = before[left]
            if leader >= 0 and symbols[leader] >= 0 and (found := merges.get(symbols[leader] * base + piece)):
                heappush(agenda, found[0] * n + leader)
        places = [i for i in range(n) if symbols[i] != gone]
        return places, [symbols[i] for i in places]

    def section_ids(self, section: str) -> bytes:
        """Ids of one section as little-endian 32-bit numbers."""
        places, found = self.merged(section)
        n_pieces = len(self.shown)
        if max(found) >= n_pieces or min(found) < 0:
            ids = []
            for place, symbol in zip(places, found, strict=True):
                if 0 <= symbol < n_pieces:
                    ids.append(symbol)
                elif self.byte_ids:
                    ids.extend(self.byte_ids[b] for b in section[place].encode())
                else:
                    ids.append(self.unknown_id)
            found = ids
        return pack(f"<{len(found)}i", *found)

    def advanced(self, sections: list[str]) -> list[bytes]:
        """Ids of many short sections: their agendas advance together, one merge each a round."""
        lengths = np.fromiter(map(len, sections), np.int64, len(sections))
        points = np.frombuffer("".join(sections).encode("utf-32-le"), "<u4").astype(np.int64)
        symbols = self.symbol_of[points]
        symbols = np.where(symbols >= 0, symbols, -2 - points)  # unknown characters keep their code point
        owner = np.repeat(np.arange(len(sections)), lengths)
        last = np.zeros(len(points), bool)
        last[np.cumsum(lengths) - 1] = True
        ranks, makes = self.ranked(symbols, np.roll(symbols, -1), last)
        done_symbols, done_owners = [], []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(ranks * len(ranks) + np.arange(len(ranks)), first)
            rank, place = np.divmod(best, len(ranks))
            open_sections = rank < NO_PAIR
            still = np.repeat(open_sections, np.diff(np.r_[first, len(owner)]))
            done_symbols.append(symbols[~still])
            done_owners.append(owner[~still])
            place = place[open_sections]
            symbols[place] = makes[place]
            last[place] = last[place + 1]
            still[place + 1] = False
            place = (np.cumsum(still) - 1)[place]
            symbols, owner, last, ranks, makes = symbols[still], owner[still], last[still], ranks[still], makes[still]
            for at in (place, place[place > 0] - 1):
                ranks[at], makes[at] = self.ranked(symbols[at], symbols[np.minimum(at + 1, len(symbols) - 1)], last[at])
        found, owner = np.concatenate(done_symbols), np.concatenate(done_owners)
        order = np.argsort(owner, kind="stable")
        found, ends = found[order], np.cumsum(np.bincount(owner, minlength=len(sections)))
        packed, starts = found.astype("<i4").tobytes(), np.r_[0, ends[:-1]]
        odd = set(np.unique(owner[order][(found < 0) | (found >= len(self.shown))]).tolist())
        ids = [packed[4 * i : 4 * j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
        for i in odd:
            ids[i] = self.section_ids(sections[i])
        return ids

    def ranked(self, left: np.ndarray, right: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the piece that each pair makes (NO_PAIR where there is none), and the piece."""
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        pair = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0) & ~last
        return np.where(pair, self.pair_ranks[at], NO_PAIR), self.pair_pieces[at]

    def keys(self, text: str) -> list[str]:
        """Sections of a text: a word stands for itself after a space mark, ``" " + section`` for any other."""
        if self.by_words and "  " not in text and SPACE_MARK not in text and text[0] != " ":
            lines = text.split("\n")
            found = lines[0].split(" ")
            for line in lines[1:]:
                words = line.split(" ")
                found.append(" \n")
                if words[0]:
                    found.append(" " + words[0])
                found += words[1:]
            return found
        sections = self.sections.findall(self.prefix + text.replace(" ", SPACE_MARK))
        return [x[1:] if x[0] == SPACE_MARK and x[1:2] != SPACE_MARK else " " + x for x in sections]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without end ids, as little-endian 32-bit numbers."""
        if len(self.known) > REMEMBERED:
            self.earlier, self.known = self.known, {}
        known, earlier = self.known, self.earlier
        keys = [self.keys(text) if text else [] for text in texts]
        missing = set().union(*keys).difference(known)
        known.update({key: earlier[key] for key in missing if key in earlier})
        fresh = [key for key in missing if key not in known]
        sections = [key[1:] if key[:1] == " " else SPACE_MARK + key for key in fresh]
        short = [i for i, section in enumerate(sections) if len(section) <= SECTION_CHARS]
        if short:
            known.update(zip([fresh[i] for i in short], self.advanced([sections[i] for i in short]), strict=True))
        long = {key: self.section_ids(section) for key, section in zip(fresh, sections, strict=True) if len(section) > SECTION_CHARS}
        if long:
            return [b"".join([known.get(key) or long[key] for key in some]) for some in keys]
        return [b"".join(map(known.__getitem__, some)) for some in keys]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: bytes that are no UTF-8 become U+FFFD one by one."""
        try:
            text = "".join(map(self.alone.__getitem__, ids))
        except TypeError:  # bytes that are no characters by themselves
            text = "".join(self.byte_runs(ids))
        first = next((i for i in ids if self.shown[i] or i in self.byte_of), None)
        return text[1:] if self.prefix and first in self.spaced else text

    def byte_runs(self, ids: list[int]) -> Iterator[str]:
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                yield readable(bytes(run))
                run.clear()
            yield self.shown[i]
        yield readable(bytes(run))


def readable(run: bytes) -> str:
    try:
        return run.decode()
    except UnicodeDecodeError as bad:
        return run[: bad.start].decode() + "�" + readable(run[bad.start + 1 :])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PieceVocabulary:
    """One vocabulary per model file and worker."""
    return PieceVocabulary(path)


def checked(pieces: PieceVocabulary, doc_ids: list, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
    """Ids with the end id and decoded texts, equal to the library's."""
    end = np.asarray([pieces.end_id], "<i4").tobytes()
    own = [np.frombuffer(ids + end, "<i4") for ids in pieces.encode(texts)]
    theirs = pieces.library.encode(texts, add_eos=True, num_threads=1)
    decoded = [pieces.decode(ids) for ids in theirs]
    for doc_id, a, b, text, other in zip(doc_ids, own, theirs, decoded, pieces.library.decode(theirs, num_threads=1), strict=True):
        if len(a) != len(b) or not np.array_equal(a, b) or text != other:
            raise ValueError(f"document {doc_id}: ids or text differ from the library's")
    return own, decoded


def encoder(model: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in batches:
            doc_ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for first, end in text_slices(texts):
                own, decoded = checked(pieces, doc_ids[first:end].to_pylist(), texts[first:end])
                offsets = np.concatenate([[0], np.cumsum([len(ids) for ids in own])]).astype("int32")
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(own)))
                yield pa.RecordBatch.from_arrays([doc_ids[first:end], ids, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return run


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` (whole text, then the end id) and ``decoded`` (the text of those ids) of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(encoder(model or default_model()), ENCODED)
