"""SentencePiece encoding with byte spans, and decoding (operator 12).

``encode`` gives the ids that the sentencepiece library gives for a model of
type BPE, and for every id the bytes of the original text it stands for:

* the text is normalised by the model's compiled character map (a double-array
  trie, read here as a table of rules): at each place the longest rule that
  matches is applied, other characters stay.  Every character of the result
  keeps the place of its source, so white space that is added, joined or
  escaped costs no alignment;
* pieces are merged in the order of their scores, the leftmost of equals
  first.  Before a space symbol, where no piece of the vocabulary crosses it,
  the text is cut; the parts are merged apart, many at a time, and remembered;
* a character without a piece falls back to the pieces of its bytes, of which
  the last carries the character's span;
* the character bounds of every piece are looked up in the alignment.

``decode`` joins the pieces of ids: the space symbol becomes a space, the one
added in front goes, runs of byte pieces are read as UTF-8 and each byte that
is none becomes U+FFFD, control pieces vanish.

Texts are independent rows: no shuffle, one Arrow slice of about
``SLICE_CHARS`` bytes (or one longer text) at a time.  The tables of
remembered parts have a fixed size per worker and change no result.

Null and empty texts have no pieces and decode to an empty text; a null list
of ids decodes to an empty text; equal rows give equal results; an empty table
gives an empty table.  ``encode`` reads the id and the text column only;
``decode`` keeps the other columns and refuses an output name in use.
"""

from __future__ import annotations

import codecs
import re
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SPACE = "▁"
SLICE_CHARS = 2_000_000
REMEMBERED = 250_000         # parts of at most REMEMBERED_CHARS characters, twice
REMEMBERED_CHARS = 48
_SHORT = 64                  # longer parts are merged through a heap
# Fixed values of the model format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

codecs.register_error("folio-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


def read_rules(blob: bytes) -> dict[str, str]:
    """The rules of a compiled character map: source text -> replacement.

    Layout: the trie's size in bytes (32 bits), its 32-bit units, then the
    replacements, each ended by a zero byte.  All nodes of one depth are
    stepped together.
    """
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob[4:4 + size], "<u4").astype(np.int64)
    texts = blob[4 + size:]

    def offset(unit):
        return (unit >> 10) << ((unit & 512) >> 6)

    rules = {}
    labels = np.arange(1, 256)
    nodes, names = np.array([offset(units[0])]), [b""]
    while len(nodes):
        next_nodes, next_names = [], []
        for lo in range(0, len(nodes), 20_000):
            at = nodes[lo:lo + 20_000, None] ^ labels[None, :]
            inside = at < len(units)
            unit = units[np.where(inside, at, 0)]
            row, col = np.nonzero(inside & ((unit & 0x800000FF) == labels[None, :]))
            got, place = unit[row, col], at[row, col]
            base = place ^ offset(got)
            for r, c, b, leaf in zip(row.tolist(), col.tolist(), base.tolist(), ((got >> 8) & 1).tolist()):
                name = names[lo + r] + bytes((c + 1,))
                if leaf:
                    start = int(units[b]) & 0x7FFFFFFF
                    rules[name.decode("utf-8")] = texts[start:texts.index(b"\0", start)].decode("utf-8")
                next_nodes.append(b)
                next_names.append(name)
        nodes, names = np.array(next_nodes, np.int64), next_names
    return rules


def _longest_first(words) -> str:
    return "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))


class PieceModel:
    """A model file's vocabulary and rules, for encoding and decoding."""

    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        trainer, normalizer = proto.trainer_spec, proto.normalizer_spec
        if trainer.model_type != trainer.BPE:
            raise ValueError("only models of type BPE are encoded here")
        if proto.denormalizer_spec.precompiled_charsmap:
            raise ValueError("models with rules for decoding are not read here")
        self.cost, self.ids, self.reserved, self.bytes_, self.user = {}, {}, {}, [0] * 256, []
        self.unknown, self.decoded, self.kind = 0, [], []
        for k, p in enumerate(proto.pieces):
            if p.type == UNUSED:
                raise ValueError("models with unused pieces are not read here")
            if p.type in (NORMAL, USER_DEFINED):
                self.cost[p.piece], self.ids[p.piece] = -p.score, k
                self.decoded.append(p.piece.replace(SPACE, " ").encode("utf-8"))
                if p.type == USER_DEFINED:
                    self.user.append(p.piece)
            else:
                self.reserved[p.piece] = k
                self.decoded.append(b"")
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes_[value] = k
                self.decoded[-1] = bytes((value,))
            elif p.type == UNKNOWN:
                self.unknown = k
                self.decoded[-1] = trainer.unk_surface.encode("utf-8")
            self.kind.append(p.type)
        self.by_bytes = trainer.byte_fallback
        self.joins_space, self.adds_space = normalizer.remove_extra_whitespaces, normalizer.add_dummy_prefix
        self.escapes, self.space_last = normalizer.escape_whitespaces, trainer.treat_whitespace_as_suffix
        self.rules = read_rules(normalizer.precompiled_charsmap)
        self.user_re = re.compile(_longest_first(self.user)) if self.user else None
        self.rule_longest = max(map(len, self.rules), default=0)
        starts = {r[0] for r in self.rules} | {u[0] for u in self.user} | {" "}
        self.plain_re = re.compile("[^" + "".join(re.escape(c) for c in sorted(starts)) + "]+")
        long_pieces = [p for p in self.ids if len(p) > 1]
        crossing = any(a != SPACE and b == SPACE for p in long_pieces for a, b in zip(p, p[1:]))
        self.part_re = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+") if not crossing else None
        # A character of no longer piece is merged with nothing.
        joined = {c for p in long_pieces for c in p}
        self.number = self.ids | self.reserved
        self._build_pairs(long_pieces, joined)
        # Parts met lately, and those met before them.
        self.seen, self.seen_before = {}, {}

    # -- normalising ------------------------------------------------------

    def _steps(self, text: str):
        """(replacement, first character, end) of every step through a text;
        a stretch without rules, symbols and spaces is one step and itself."""
        at, n = 0, len(text)
        while at < n:
            plain = self.plain_re.match(text, at)
            if plain:
                yield None, at, plain.end()
                at = plain.end()
                continue
            symbol = self.user_re.match(text, at) if self.user_re else None
            if symbol:
                yield symbol.group(), at, symbol.end()
                at = symbol.end()
                continue
            for width in range(min(self.rule_longest, n - at), 0, -1):
                rule = self.rules.get(text[at:at + width])
                if rule is not None:
                    break
            else:
                width, rule = 1, text[at]
            yield rule, at, at + width
            at += width

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and its end,
        the byte of ``text`` where its source starts."""
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        # The byte at which each character starts, and the end.
        byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.rules and not self.user and not self.joins_space:
            out, source = text, byte_of
            if self.adds_space and not self.space_last:
                out, source = " " + out, np.concatenate(([0], source))
            elif self.adds_space:
                out, source = out + " ", np.append(source, byte_of[-1])
            return (out.replace(" ", SPACE) if self.escapes else out), source
        parts, chars = [], []
        after_space, lead = self.joins_space, 0
        steps = self._steps(text)
        if self.joins_space:
            steps = list(steps)
            while steps and steps[0][0] == " ":
                lead = steps.pop(0)[2]
            if not steps:
                return "", byte_of[[lead]]
        if self.adds_space and not self.space_last:
            parts.append(" ")
            chars.append(lead)
        for new, a, b in steps:
            if new is None:
                parts.append(text[a:b])
                chars.extend(range(a, b))
                after_space = False
                continue
            if after_space:
                new = new.lstrip(" ")
            if new:
                parts.append(new)
                chars.extend([a] * len(new))
                after_space = self.joins_space and new.endswith(" ")
        out, stop = "".join(parts), len(text)
        if self.escapes:
            out = out.replace(" ", SPACE)
        if self.joins_space:
            space = SPACE if self.escapes else " "
            while out.endswith(space):
                out, stop = out[:-1], chars.pop()
        if self.adds_space and self.space_last:
            out += SPACE if self.escapes else " "
            chars.append(stop)
        return out, byte_of[np.array(chars + [stop], np.int64)]

    # -- merging ----------------------------------------------------------

    def _build_pairs(self, long_pieces: list[str], joined: set[str]) -> None:
        """Symbols (pieces and characters of pieces) and, for every two that
        make a piece, its cost and symbol, in the order of the pair's key."""
        names = sorted(self.ids.keys() | joined)
        symbol = {name: k for k, name in enumerate(names)}
        # The last entry stands for characters that are no symbol.
        self.symbol_id = np.array([self.number.get(name, -1) for name in names] + [-1], np.int64)
        self.symbol_width = np.array([len(name) for name in names] + [1], np.int64)
        self.symbol_of = np.full(0x110000, len(names), np.int64)
        for c in joined | {name for name in names if len(name) == 1}:
            self.symbol_of[ord(c)] = symbol[c]
        pairs = []
        for piece in long_pieces:
            for k in range(1, len(piece)):
                left, right = symbol.get(piece[:k]), symbol.get(piece[k:])
                if left is not None and right is not None:
                    pairs.append((left * (len(names) + 1) + right, self.cost[piece], symbol[piece]))
        pairs.sort()
        self.pair_key = np.array([x[0] for x in pairs] or [-1], np.int64)
        self.pair_cost = np.array([x[1] for x in pairs] + [np.inf])
        self.pair_symbol = np.array([x[2] for x in pairs] + [-1], np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost and symbol of two neighbours' piece; infinite where none."""
        key = left * len(self.symbol_id) + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        at = np.where(self.pair_key[at] == key, at, len(self.pair_cost) - 1)
        return self.pair_cost[at], self.pair_symbol[at]

    def _merge_together(self, parts: list[str]) -> list[tuple[tuple, tuple]]:
        """Ids and widths of many parts.  In every round the cheapest pair of
        each part, the leftmost of equals, is merged in all of them at once."""
        if not parts:
            return []
        text = "".join(parts)
        symbol = self.symbol_of[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        place = np.arange(len(text))
        part = np.repeat(np.arange(len(parts)), np.diff(bounds))
        cost, joined = np.full(len(text), np.inf), np.full(len(text), -1, np.int64)
        inner = np.flatnonzero(part[1:] == part[:-1])
        cost[inner], joined[inner] = self._pairs(symbol[inner], symbol[inner + 1])
        ready = []
        while len(part):
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            best = np.repeat(np.minimum.reduceat(cost, first), np.diff(np.append(first, len(part))))
            open_ = best < np.inf
            if not open_.all():
                ready.append((place[~open_], symbol[~open_]))
                place, symbol, part, cost, joined, best = (x[open_] for x in (place, symbol, part, cost, joined, best))
                if not len(part):
                    break
            at = np.flatnonzero(cost == best)
            at = at[np.concatenate(([True], part[at[1:]] != part[at[:-1]]))]
            symbol[at] = joined[at]
            kept = np.ones(len(part), bool)
            kept[at + 1] = False
            place, symbol, part, cost, joined = (x[kept] for x in (place, symbol, part, cost, joined))
            at = at - np.arange(len(at))
            # The pairs on both sides of a merged symbol are new.
            at = np.concatenate((at, at[at > 0] - 1))
            last = at == len(part) - 1
            right = np.where(last, at, at + 1)
            inside = ~last & (part[at] == part[right])
            cost[at], joined[at] = np.inf, -1
            at, right = at[inside], right[inside]
            cost[at], joined[at] = self._pairs(symbol[at], symbol[right])
        place, symbol = (np.concatenate(x) for x in zip(*ready))
        turn = np.argsort(place)
        place, symbol = place[turn], symbol[turn]
        ids, split = self.symbol_id[symbol].tolist(), np.searchsorted(place, bounds).tolist()
        widths, places = self.symbol_width[symbol].tolist(), np.append(place, len(text)).tolist()
        odd = set(np.searchsorted(bounds, place[self.symbol_id[symbol] < 0], side="right").tolist())
        out = []
        for k, (lo, hi) in enumerate(zip(split, split[1:])):
            if k + 1 in odd:
                out.append(self._numbered([text[a:b] for a, b in zip(places[lo:hi], places[lo + 1:hi + 1])]))
            else:
                out.append((tuple(ids[lo:hi]), tuple(widths[lo:hi])))
        return out

    def _merge_long(self, part: str) -> tuple[tuple, tuple]:
        """Ids and widths of one long part, its pairs in a heap."""
        cost = self.cost
        pieces = list(part)
        n = len(pieces)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(cost[a + b], k, a + b) for k, (a, b) in enumerate(zip(pieces, pieces[1:])) if a + b in cost]
        heapify(heap)
        while heap:
            _, k, joined = heappop(heap)
            right = after[k]
            # Pairs whose sides have grown or gone since are passed over.
            if not pieces[k] or right >= n or pieces[k] + pieces[right] != joined:
                continue
            pieces[k], pieces[right] = joined, ""
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
                if joined + pieces[after[k]] in cost:
                    heappush(heap, (cost[joined + pieces[after[k]]], k, joined + pieces[after[k]]))
            if before[k] >= 0 and pieces[before[k]] + joined in cost:
                heappush(heap, (cost[pieces[before[k]] + joined], before[k], pieces[before[k]] + joined))
        return self._numbered([p for p in pieces if p])

    def _numbered(self, pieces: list[str]) -> tuple[tuple, tuple]:
        """Ids of pieces and the characters that each stands for."""
        ids, widths = [], []
        for p in pieces:
            k = self.number.get(p)
            if k is None and self.by_bytes:
                data = p.encode("utf-8")
                ids.extend(self.bytes_[b] for b in data)
                widths.extend([0] * (len(data) - 1) + [len(p)])
                continue
            ids.append(self.unknown if k is None else k)
            widths.append(len(p))
        return tuple(ids), tuple(widths)

    def _known(self, parts: list[str]) -> list[tuple[tuple, tuple]]:
        """(ids, widths) of different parts, those not met lately merged."""
        out, new = [], []
        for k, part in enumerate(parts):
            got = self.seen.get(part)
            if got is None:
                got = self.seen_before.get(part)
                if got is None:
                    new.append(k)
                else:
                    self._remember(part, got)
            out.append(got)
        together = [k for k in new if len(parts[k]) <= _SHORT]
        for k, got in zip(together, self._merge_together([parts[k] for k in together])):
            out[k] = got
        for k in new:
            if out[k] is None:
                out[k] = self._merge_long(parts[k])
            if len(parts[k]) <= REMEMBERED_CHARS:
                self._remember(parts[k], out[k])
        return out

    def _remember(self, part: str, got: tuple) -> None:
        if len(self.seen) >= REMEMBERED:
            self.seen, self.seen_before = {}, self.seen
        self.seen[part] = got

    def _parts(self, text: str) -> list[str]:
        """Parts of a normalised text that are merged apart."""
        if not self.part_re:
            return [text] if text else []
        return self.part_re.findall(text)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of the texts' ids, all ids one after another, and the bytes
        of its text at which each one starts and ends."""
        normal = [self.normalise(t) for t in texts]
        if not self.user:
            cuts = [self._parts(t) for t, _ in normal]
        else:
            # A symbol of the user's is a part of its own, known beforehand.
            cuts = []
            for text, _ in normal:
                cut, at = [], 0
                for symbol in self.user_re.finditer(text):
                    cut += self._parts(text[at:symbol.start()])
                    cut.append((symbol.group(),))
                    at = symbol.end()
                cuts.append(cut + self._parts(text[at:]))
        number = dict.fromkeys(chain.from_iterable(cuts))
        plain = [p for p in number if type(p) is str]
        known = self._known(plain)
        for symbol in (p for p in number if type(p) is not str):
            plain.append(symbol)
            known.append(((self.ids[symbol[0]],), (len(symbol[0]),)))
        number = {p: k for k, p in enumerate(plain)}
        at = np.concatenate(([0], np.cumsum([len(ids) for ids, _ in known]))).astype(np.int64)
        part_ids = np.fromiter(chain.from_iterable(ids for ids, _ in known), np.int32, int(at[-1]))
        part_widths = np.fromiter(chain.from_iterable(widths for _, widths in known), np.int64, int(at[-1]))
        # Every part's ids in the order of the texts.
        counts = [len(cut) for cut in cuts]
        parts = np.fromiter(map(number.__getitem__, chain.from_iterable(cuts)), np.int64, sum(counts))
        size = at[parts + 1] - at[parts]
        ends = np.cumsum(size)
        place = np.repeat(at[parts] - (ends - size), size) + np.arange(int(size.sum()))
        ids, widths = part_ids[place], part_widths[place]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts))).astype(np.int64)]
        stop = np.cumsum(widths)
        if not self.by_bytes and len(ids):
            # Unknown pieces of a text in a row are one.
            last = np.append((ids[1:] != self.unknown) | (ids[:-1] != self.unknown), True)
            last[bounds[1:][bounds[1:] > 0] - 1] = True
            ids, stop = ids[last], stop[last]
            widths = np.diff(np.concatenate(([0], stop)))
            bounds = np.concatenate(([0], np.cumsum(last)))[bounds]
        # A text has one place more in its alignment than characters.
        source = np.concatenate([s for _, s in normal]) if normal else np.zeros(0, np.int64)
        shift = np.repeat(np.arange(len(texts)), np.diff(bounds))
        return bounds, ids, source[stop - widths + shift], source[stop + shift]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text and the bytes at which each one starts and ends."""
        return self.encode_many([text])[1:]

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: list) -> str:
        table, kind = self.decoded, self.kind
        parts = list(map(table.__getitem__, ids))
        if self.adds_space or self.joins_space:
            for at, k in enumerate(ids):
                if kind[k] == CONTROL:
                    continue
                if kind[k] not in (NORMAL, USER_DEFINED) or not parts[at].startswith(b" "):
                    break
                parts[at] = parts[at][1:]
                if not self.joins_space or parts[at]:
                    break
        return b"".join(parts).decode("utf-8", "folio-each-byte")


_LOADED: dict[int, tuple[bytes, PieceModel]] = {}


def _model(blob: bytes) -> PieceModel:
    """The model of a file's bytes, built once per worker."""
    key = hash(blob)
    if key not in _LOADED or _LOADED[key][0] != blob:
        _LOADED.clear()
        _LOADED[key] = (blob, PieceModel(blob))
    return _LOADED[key][1]


def _slices(sizes: list[int], limit: int):
    """Bounds of row slices of about ``limit`` in size; a larger row is alone."""
    first, held = 0, 0
    for k, size in enumerate(sizes):
        if k > first and held + size > limit:
            yield first, k
            first, held = k, 0
        held += size
    if sizes:
        yield first, len(sizes)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``id, ids, starts, ends`` of every row: the pieces of its text and the
    UTF-8 bytes [start, end) of the text that each one stands for.  With
    ``decoded`` also the text that ``decode`` gives for the ids, without
    another pass through the workers."""
    with open(model_path, "rb") as file:
        blob = file.read()
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, ids array<int>, starts array<bigint>, ends array<bigint>"
    names = [id_col, "ids", "starts", "ends"]
    if decoded:
        schema, names = f"{schema}, decoded string", [*names, "decoded"]

    def run(batches):
        model = _model(blob)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for lo, hi in _slices(sizes, SLICE_CHARS):
                bounds, ids, starts, ends = model.encode_many([t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()])
                offsets = pa.array(bounds.astype(np.int32))
                columns = [batch.column(0).slice(lo, hi - lo), *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (ids, starts, ends))]
                if decoded:
                    flat, edge = ids.tolist(), bounds.tolist()
                    columns.append(pa.array([model.decode(flat[a:b]) for a, b in zip(edge, edge[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of their lists of ids."""
    if out_col in rows.columns:
        raise ValueError(f"column {out_col} exists already")
    with open(model_path, "rb") as file:
        blob = file.read()
    schema = StructType([*rows.schema.fields, StructField(out_col, StringType())])
    place = rows.columns.index(ids_col)

    def run(batches):
        model = _model(blob)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_pylist()
            for lo, hi in _slices(sizes, SLICE_CHARS // 4):
                part = batch.slice(lo, hi - lo)
                texts = [model.decode(ids or []) for ids in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col])

    return rows.mapInArrow(run, schema)
