"""SentencePiece encoding and decoding by batched numpy Viterbi.

Texts are cut into words (a run of word marks and what follows it, cut again
between characters that no piece holds side by side), every distinct word is segmented once, and words of
equal length advance together: at each position the substrings that end there
are hashed from prefix sums, probed in the sorted piece keys, scored, and the
vectorised maximum stores the backpointer.

The scores follow the model's kind. Unigram: the sum of piece scores. BPE: the
sum of scores is not what merging gives, but a segmentation is the merge result
exactly if each of its pieces merges to itself and each neighbouring pair merges
to that pair; so a step scores 0 where the piece is compatible with the last piece of
the best path it extends and -inf elsewhere, and one candidate is left. Compatibility
is found by undoing merges on both sides of the boundary, vectorised over pairs.

Characters without a piece become byte pieces (or <unk>). Decoding is a ragged
gather of piece bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm import textvec as V

MARK = 0x2581
#: Characters worked on at a time, and distinct words a task remembers.
BLOCK_CHARS, REMEMBERED = 1_000_000, 400_000
#: Longer words advance alone.
LONG = 48
UNIGRAM, BPE = 1, 2


def char_codes(cp: np.ndarray) -> np.ndarray:
    return V.mix(cp.astype(V.U) + V.U(0x51ED270B)) | V.U(1)


class PrefixHash:
    """Polynomial hashes of substrings from prefix sums: raw hash sum(code_i * BASE^i)."""

    def __init__(self, cp: np.ndarray):
        fwd, self.inv = V._powers(len(cp) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([[V.U(0)], np.cumsum(char_codes(cp) * fwd[: len(cp)], dtype=V.U)])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.inv[start]


def ragged(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[first[i]: first[i] + count[i]] of all i, joined."""
    total = np.cumsum(count)
    if not len(total) or not total[-1]:
        return flat[:0]
    return flat[np.repeat(first - (total - count), count) + np.arange(total[-1])]


class Codec:
    """A SentencePiece model read from its file (vocabulary, scores, kind, normaliser)."""

    def __init__(self, proto: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto.FromString(proto)
        self.processor = SentencePieceProcessor(model_proto=proto)
        norm = model.normalizer_spec
        self.dummy = norm.add_dummy_prefix
        self.plain = norm.name == "identity" and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
        self.bpe = model.trainer_spec.model_type == BPE
        self.unk, self.fallback = self.processor.unk_id(), model.trainer_spec.byte_fallback
        kinds = [p.type for p in model.pieces]                  # 1 normal, 2 unknown, 3 control, 4 user, 6 byte
        self.pieces = [p.piece for p in model.pieces]
        if any(k == 4 for k in kinds) or any("▁" in p.lstrip("▁") for p, k in zip(self.pieces, kinds, strict=True) if k == 1):
            raise ValueError("models with user-defined pieces or pieces over word ends are not handled")
        self.bytes = np.full(256, self.unk, dtype=np.int64)
        for i, k in enumerate(kinds):
            if k == 6:
                self.bytes[int(self.pieces[i][3:5], 16)] = i
        self._index([i for i, k in enumerate(kinds) if k == 1], np.array([p.score for p in model.pieces]))
        self._decode_table(kinds)
        self.known = np.zeros(0, V.U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    # ---- tables ---------------------------------------------------------------------------------

    def _index(self, ids: list[int], scores: np.ndarray) -> None:
        text = [self.pieces[i] for i in ids]
        cp = np.frombuffer("".join(text).encode("utf-32-le"), dtype=np.uint32)
        size = np.array([len(t) for t in text])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        raw = PrefixHash(cp).raw(start, start + size)
        # rank: single characters first (they are what merging starts from), then by falling score
        order = np.lexsort((np.arange(len(ids)), -scores[ids], size > 1))
        self.n, self.atoms = len(ids), int((size == 1).sum())
        self.ids, self.size, self.raw = np.array(ids)[order], size[order], raw[order]
        self.score = scores[self.ids]
        self.longest = int(self.size.max())
        with np.errstate(over="ignore"):
            key = V.mix(self.raw + self.size.astype(V.U))
        self.key_order = np.argsort(key)
        self.keys = key[self.key_order]
        self.table = V.HashSet(self.keys, bits=20)
        inner = np.ones(len(cp), dtype=bool)
        inner[np.cumsum(size) - 1] = False
        at = np.flatnonzero(inner)
        # neighbours inside some piece: a table over the characters of pieces of two or more
        letters = np.unique(cp[np.repeat(size > 1, size)])
        self.letter = np.zeros(0x110000, dtype=np.int32)
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.crossed = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        self.crossed[self.letter[cp[at]], self.letter[cp[at + 1]]] = True
        self.left, self.right = np.arange(self.n), np.arange(self.n)
        self.own = np.ones(self.n, dtype=bool)
        if self.bpe:
            self._merge_tables([text[i] for i in order])

    def find(self, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rank of the piece with a raw hash and length, or -1."""
        out = np.full(len(raw), -1, dtype=np.int64)
        with np.errstate(over="ignore"):
            at, which = self.table.index(V.mix(raw + size.astype(V.U)))
        out[at] = self.key_order[which]
        return out

    def _merge_tables(self, text: list[str]) -> None:
        """For each piece the two pieces its last merge joins, and whether merging its
        characters gives the piece at all."""
        rank = {t: i for i, t in enumerate(text)}
        for r in range(self.atoms, self.n):
            parts = [rank.get(c, -1) for c in text[r]]
            spell = list(text[r])
            while len(parts) > 2:
                best, at = min((rank.get(spell[i] + spell[i + 1], self.n), i) for i in range(len(spell) - 1))
                if best >= r:
                    break
                spell[at:at + 2] = [text[best]]
                parts[at:at + 2] = [best]
            if len(parts) == 2 and min(parts) >= 0:
                self.left[r], self.right[r] = parts
            else:
                self.own[r] = False

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of pieces a and b (ranks) gives a, b again.

        The last merges on either side are undone in turn, latest first; if at some
        point the two pieces at the boundary have a merge earlier than what was undone,
        that merge would have come first.
        """
        ok = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), np.full(len(a), self.n, dtype=np.int64)
        fwd, _ = V._powers(self.longest + 1)
        while len(live):
            with np.errstate(over="ignore"):
                joined = self.find(self.raw[a] + self.raw[b] * fwd[self.size[a]], self.size[a] + self.size[b])
            bad = (joined >= 0) & (joined < limit)
            ok[live[bad]] = False
            undo_a = (a > b) & (a >= self.atoms)
            undo_b = ~undo_a & (b >= self.atoms)
            done = bad | ~(undo_a | undo_b)
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_b, self.left[b], b)
            live, a, b, limit = live[~done], a[~done], b[~done], limit[~done]
        return ok

    # ---- encoding -------------------------------------------------------------------------------

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        if not self.plain:
            return self.processor.normalize(text)
        return ("▁" if self.dummy else "") + text.replace(" ", "▁")

    def _together(self, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over a (words, length) matrix of characters: piece ranks of the words, joined
        (-1 for a character without a piece), and their numbers."""
        n, size = cp.shape
        prefix = PrefixHash(cp.ravel())
        row = np.arange(n) * size
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        last = np.full((size + 1, n), -1, dtype=np.int64)
        back = np.zeros((size + 1, n), dtype=np.int64)
        low = self.score.min() - 10 if self.n else -10
        for j in range(1, size + 1):
            spans = min(j, self.longest)
            start = (row + j)[None, :] - np.arange(1, spans + 1)[:, None]
            raw = prefix.raw(start.ravel(), np.tile(row + j, spans))
            piece = self.find(raw, np.repeat(np.arange(1, spans + 1), n)).reshape(spans, n)
            k, w = np.nonzero(piece >= 0)
            p = piece[k, w]
            before = last[j - 1 - k, w]
            if self.bpe:
                fits = self.own[p]
                pair = np.flatnonzero(fits & (before >= 0))
                code, at = np.unique(before[pair] * self.n + p[pair], return_inverse=True)
                fits[pair] = self._pairs(code)[at]
                gain = np.where(fits, best[j - 1 - k, w], -np.inf)
            else:
                gain = best[j - 1 - k, w] + self.score[p]
            grid = np.full((spans, n), -np.inf)
            grid[k, w] = gain
            grid[0] = np.where(piece[0] < 0, best[j - 1] + (0 if self.bpe else low), grid[0])
            top = np.argmax(grid, axis=0)
            best[j], back[j] = grid[top, np.arange(n)], top + 1
            last[j] = piece[top, np.arange(n)]
        pos, steps = np.full(n, size), []
        while pos.any():
            steps.append(np.where(pos > 0, last[pos, np.arange(n)], -2))
            pos = pos - back[pos, np.arange(n)]
        path = np.stack(steps[::-1], axis=1)
        return path[path > -2], (path > -2).sum(axis=1)

    def _pairs(self, code: np.ndarray) -> np.ndarray:
        """``compatible`` of coded pairs, remembered in a bounded table."""
        if not hasattr(self, "pair_keys") or len(self.pair_keys) > 2_000_000:
            self.pair_keys, self.pair_ok = np.zeros(0, np.int64), np.zeros(0, bool)
        at = np.searchsorted(self.pair_keys, code)
        have = np.zeros(len(code), dtype=bool)
        inside = at < len(self.pair_keys)
        have[inside] = self.pair_keys[at[inside]] == code[inside]
        ok = np.zeros(len(code), dtype=bool)
        ok[have] = self.pair_ok[at[have]]
        new = code[~have]
        if len(new):
            ok[~have] = self.compatible(new // self.n, new % self.n)
            self.pair_keys = np.insert(self.pair_keys, at[~have], new)
            self.pair_ok = np.insert(self.pair_ok, at[~have], ok[~have])
        return ok

    def _ids(self, cp: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Piece ids of one word's path, unknown characters as byte pieces or <unk>."""
        if (ranks >= 0).all():
            return self.ids[ranks]
        out, at, unknown = [], 0, False
        for r in ranks.tolist():
            if r >= 0:
                out.append(self.ids[r])
                at += self.size[r]
            else:
                if self.fallback:
                    out += self.bytes[list(chr(cp[at]).encode("utf-8", "surrogatepass"))].tolist()
                elif not unknown or self.bpe:
                    out.append(self.unk)
                at += 1
            unknown = r < 0
        return np.array(out, dtype=np.int64)

    def words(self, cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids joined, number of ids) of the given distinct words."""
        size, flat, first, count, total = end - start, [], np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), 0

        def put(some, ids, n):
            nonlocal total
            first[some], count[some] = total + np.cumsum(n) - n, n
            flat.append(ids)
            total += len(ids)

        for length in np.unique(size[size <= LONG]):
            own = np.flatnonzero(size == length)
            for a in range(0, len(own), 20_000):
                grid = cp[start[own[a:a + 20_000]][:, None] + np.arange(length)]
                ranks, n = self._together(grid)
                odd = np.add.reduceat(ranks < 0, np.cumsum(n) - n) > 0
                plain = ~np.repeat(odd, n)
                put(own[a:a + 20_000][~odd], self.ids[ranks[plain]], n[~odd])
                ends = np.cumsum(n)
                for i in np.flatnonzero(odd):
                    ids = self._ids(grid[i], ranks[ends[i] - n[i]:ends[i]])
                    put(own[a + i:a + i + 1], ids, np.array([len(ids)]))
        for i in np.flatnonzero(size > LONG):
            ids = self._alone(cp[start[i]:end[i]])
            put(np.array([i]), ids, np.array([len(ids)]))
        return ragged(np.concatenate(flat) if flat else np.zeros(0, np.int64), first, count).astype(np.int32), count

    def _alone(self, cp: np.ndarray) -> np.ndarray:
        """One very long word: its positions advance one at a time."""
        text = "".join(map(chr, cp))
        if not hasattr(self, "by_text"):
            self.by_text = {self.pieces[i]: r for r, i in enumerate(self.ids)}
        get, memo, low = self.by_text.get, {}, float(self.score.min() - 10)
        last, back, best = [-1] * (len(text) + 1), [0] * (len(text) + 1), [0.0] * (len(text) + 1)
        for j in range(1, len(text) + 1):
            top = (-np.inf, -1, 1)
            for k in range(1, min(j, self.longest) + 1):
                r = get(text[j - k:j], -1)
                if r < 0:
                    gain = best[j - 1] + (0 if self.bpe else low) if k == 1 else -np.inf
                elif not self.bpe:
                    gain = best[j - k] + float(self.score[r])
                else:
                    pair = (last[j - k], r)
                    if pair not in memo:
                        memo[pair] = bool(self.own[r]) and (pair[0] < 0 or bool(self.compatible(np.array([pair[0]]), np.array([r]))[0]))
                    gain = 0.0 if memo[pair] else -np.inf
                if gain > top[0]:
                    top = (gain, r, k)
            best[j], last[j], back[j] = top
        j, path = len(text), []
        while j:
            path.append(last[j])
            j -= back[j]
        return self._ids(cp, np.array(path[::-1], dtype=np.int64))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids joined, row offsets) of texts."""
        own = [self.normalise(t) for t in texts]
        cp = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        rows = np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int64)
        if not len(cp):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        mark = cp == MARK
        first = mark.copy()
        first[1:] &= ~mark[:-1]
        if self.fallback:               # no piece reaches over this place: the parts are segmented apart
            letter = self.letter[cp]
            first[1:] |= ~self.crossed[letter[:-1], letter[1:]] & ~(mark[1:] & mark[:-1])
        first[rows[:-1][rows[:-1] < len(cp)]] = True
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(cp))
        with np.errstate(over="ignore"):
            h = V.mix(PrefixHash(cp).raw(start, end) + (end - start).astype(V.U))
        values, at, which = np.unique(h, return_index=True, return_inverse=True)
        keys, first_id, count, flat = self.known
        place = np.minimum(np.searchsorted(keys, values), max(len(keys) - 1, 0))
        new = np.flatnonzero(keys[place] != values) if len(keys) else np.arange(len(values))
        if len(new):
            ids, n = self.words(cp, start[at[new]], end[at[new]])
            if len(keys) > REMEMBERED:
                keys, first_id, count, flat = values[:0], first_id[:0], count[:0], flat[:0]
                new = np.arange(len(values))
                ids, n = self.words(cp, start[at], end[at])
            if len(keys):
                spot = place[new] + (keys[place[new]] < values[new])
                keys = np.insert(keys, spot, values[new])
                first_id = np.insert(first_id, spot, len(flat) + np.cumsum(n) - n)
                count = np.insert(count, spot, n)
                flat = np.concatenate([flat, ids])
            else:
                keys, first_id, count, flat = values, np.cumsum(n) - n, n, ids
            self.known = keys, first_id, count, flat
            place = np.searchsorted(keys, values)
        word = place[which]
        n = count[word]
        total = np.concatenate([[0], np.cumsum(n)])
        return ragged(flat, first_id[word], n), total[np.searchsorted(start, rows)]

    # ---- decoding -------------------------------------------------------------------------------

    def _decode_table(self, kinds: list[int]) -> None:
        raw = [bytes([int(p[3:5], 16)]) if k == 6 else b"" if k == 3 else " ⁇ ".encode() if k == 2 else p.replace("▁", " ").encode()
               for p, k in zip(self.pieces, kinds, strict=True)]
        self.out = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.out_size = np.array([len(x) for x in raw])
        self.out_first = np.concatenate([[0], np.cumsum(self.out_size)[:-1]])
        # an id that is no piece reads as U+FFFD, kept behind the pieces
        unknown = np.frombuffer("\ufffd".encode(), np.uint8)
        self.out_first, self.out_size = np.append(self.out_first, len(self.out)), np.append(self.out_size, len(unknown))
        self.out = np.concatenate([self.out, unknown])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes joined, row offsets); the mark put before a text is taken off again."""
        none = len(self.out_size) - 1
        ids = np.where((ids < 0) | (ids >= none), none, ids)
        size = self.out_size[ids]
        data = ragged(self.out, self.out_first[ids], size)
        rows = np.concatenate([[0], np.cumsum(size)])[offsets]
        if self.dummy:
            full = rows[:-1][np.diff(rows) > 0]
            drop = full[data[full] == 32]
            data = np.delete(data, drop)
            rows = rows - np.searchsorted(drop, rows)
        return data, rows


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:          # a file of the installation, read on the driver
        return f.read()


def text_blocks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    _, offsets = V.text_buffers(column)
    for i, j in V.row_blocks(offsets, BLOCK_CHARS):
        yield i, [t or "" for t in column.slice(i, j - i).to_pylist()]


def _encode_pass(proto: bytes):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(proto)
        for batch in batches:
            data, offsets = V.text_buffers(batch.column(1))
            for i, texts in text_blocks(batch.column(1)):
                ids, rows = codec.encode(texts)
                back, ends = codec.decode(ids, rows)
                own = data[offsets[i]: offsets[i + len(texts)]]
                same = np.diff(ends) == np.diff(offsets[i:i + len(texts) + 1])
                if len(own) == len(back):
                    wrong = np.flatnonzero(own != back)
                    same[np.searchsorted(ends, wrong, side="right") - 1] = False
                else:
                    for r in range(len(texts)):
                        a, b = offsets[i + r], offsets[i + r + 1]
                        same[r] = same[r] and bool((data[a:b] == back[ends[r]:ends[r + 1]]).all())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, len(texts)), pa.array(np.diff(rows)),
                     pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids)), pa.array(same)],
                    ["doc_id", "n_tokens", "ids", "round_trip"])
    return run


def _decode_pass(proto: bytes):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(proto)
        for batch in batches:
            lists = batch.column(1).fill_null([])
            ids, rows = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            data, ends = codec.decode(ids, rows)
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())], ["doc_id", "text"])
    return run


def encode(docs: DataFrame, proto: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every row of ``docs``.

    ``round_trip``: decoding gives the text back byte for byte (a word mark U+2581 in a
    text comes back as a space). Null and empty texts have no ids. Rows with null ids
    and repeated rows are kept; other columns are ignored; an empty table gives none.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _encode_pass(proto), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode(rows: DataFrame, proto: bytes) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text); null or empty ids give an empty text. Null ids within a list,
    ids that are no piece and bytes that are no UTF-8 come out as U+FFFD."""
    return rows.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(_decode_pass(proto), "doc_id long, text string")
