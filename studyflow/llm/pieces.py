"""Encoding by pieces with log scores: the best path over a double-array trie, with byte fallback and blank markers.

The pieces and scores come from a model file. A text is its words with the marker for each blank (and one before the text); pieces hold the marker
only at their start or are made of markers, so the best path falls apart into chunks "markers and the letters after them". A task looks chunks up,
and finds the best paths of those it has not seen all at once: every step of the search goes over all chunks of a size in numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.llm.shared import documents, held_in_worker

MARK = "▁"
REMEMBERED = 400_000
SLICE = 2_000_000
# A chunk over this many characters is searched by itself.
LONG = 64
# Below the least score of a piece: the score of a character that no piece covers.
UNKNOWN = 10.0


class DoubleArray:
    """A trie in two arrays: the child of node s by code c is t = base[s] + c if check[t] is s. ``value`` is the piece that ends in a node, or -1."""

    def __init__(self, words: dict[tuple[int, ...], int], codes: int):
        children: dict[int, dict[int, int]] = {0: {}}
        ends: dict[int, int] = {}
        count = 1
        for word, value in words.items():
            node = 0
            for c in word:
                if c not in children[node]:
                    children[node][c] = count
                    children[count] = {}
                    count += 1
                node = children[node][c]
            ends[node] = value
        size = 4 * (count + codes) + 4096
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free, place = np.ones(size, bool), {0: 0}
        free[0] = False
        # Slots below are nearly all taken; a search begins above.
        first = 1
        todo = [0]
        while todo:
            node = todo.pop()
            value[place[node]] = ends.get(node, -1)
            if not children[node]:
                continue
            wanted = np.array(sorted(children[node]), np.int64)
            at, low = -1, max(first, int(wanted[0]) + 1)
            while at < 0:
                spots = low + np.flatnonzero(free[low : low + 2048]) - wanted[0]
                fits = spots[free[spots[:, None] + wanted].all(axis=1)]
                if len(fits):
                    at = int(fits[0])
                low += 2048
            spots = at + wanted
            base[place[node]] = at
            free[spots] = False
            check[spots] = place[node]
            for c, spot in zip(wanted.tolist(), spots.tolist()):
                place[children[node][c]] = spot
                todo.append(children[node][c])
            while not free[first : first + 1024].sum() > 32:
                first += 1024
        self.base, self.check, self.value = base, check, value

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The children, or -1."""
        at = self.base[node] + code
        at = np.where(at < len(self.check), at, 0)
        return np.where((node >= 0) & (self.check[at] == node) & (at > 0), at, -1)


def log_scores(given: np.ndarray) -> np.ndarray:
    """Log scores of pieces. Scores that are negated ranks (0, -1, -2, ...) become log frequencies by Zipf's law, in steps of 1/1024.

    A score beyond all ranks marks a piece for want of another and gets the last rank. Other scores are logs already.
    """
    ranks = -given
    if (given != np.round(given)).any() or (ranks < 0).any():
        return given
    ranks = np.minimum(ranks, len(given))
    return -np.round(np.log((ranks + 1) * (1 / np.arange(1, len(given) + 1)).sum()) * 1024) / 1024


class Pieces:
    """The pieces of a model file: texts, scores and the ids of the 256 byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(k) for k in range(n)]
        plain = [k for k in range(n) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
        self.bytes_id = [self.text.index(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {k: b for b, k in enumerate(self.bytes_id)}
        self.control = {k for k in range(n) if model.is_control(k)}
        self.unknown = model.unk_id()
        score = np.zeros(n)
        score[plain] = log_scores(np.array([model.get_score(k) for k in plain]))
        self.score = score
        self.beyond = float(score[plain].min()) - UNKNOWN
        self.code = {c: k + 1 for k, c in enumerate(sorted({c for k in plain for c in self.text[k]}))}
        self.trie = DoubleArray({tuple(self.code[c] for c in self.text[k]): k for k in plain}, len(self.code) + 1)
        self.longest = max(len(self.text[k]) for k in plain)
        self.chunks: dict[str, bytes] = {}
        self.walk = None

    def as_bytes(self, char: str) -> list[int]:
        return [self.bytes_id[b] for b in char.encode("utf-8", "surrogatepass")]

    def best_path(self, chunk: str) -> list[int]:
        """The best path of one chunk; of equals, the piece that starts first wins."""
        if self.walk is None:
            self.walk = self.trie.base.tolist(), self.trie.check.tolist(), self.trie.value.tolist()
        base, check, value = self.walk
        score, size = self.score, len(chunk)
        codes = [self.code.get(c, 0) for c in chunk]
        best, back, piece = [0.0] + [None] * size, [0] * (size + 1), [-1] * (size + 1)
        for start in range(size):
            node, here, lone = 0, best[start], False
            for end in range(start + 1, min(size, start + self.longest) + 1):
                c = codes[end - 1]
                at = base[node] + c
                if not c or at >= len(check) or check[at] != node:
                    break
                node = at
                k = value[node]
                if k >= 0:
                    lone = lone or end == start + 1
                    total = here + score[k]
                    if best[end] is None or total > best[end]:
                        best[end], back[end], piece[end] = total, start, k
            if not lone:
                total = here + self.beyond
                if best[start + 1] is None or total > best[start + 1]:
                    best[start + 1], back[start + 1], piece[start + 1] = total, start, -1
        out: list[int] = []
        end = size
        while end:
            out += [piece[end]] if piece[end] >= 0 else self.as_bytes(chunk[back[end]])[::-1]
            end = back[end]
        return out[::-1]

    def best_paths(self, chunks: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of the best path of each chunk of at most ``LONG`` characters."""
        n, width = len(chunks), max(map(len, chunks))
        points = np.frombuffer("".join(c.ljust(width, "\0") for c in chunks).encode("utf-32-le", "surrogatepass"), "<u4").reshape(n, width)
        known, code_at = np.unique(points, return_inverse=True)
        codes = np.array([self.code.get(chr(c), 0) for c in known.tolist()], np.int64)[code_at].reshape(n, width)
        sizes = np.fromiter(map(len, chunks), np.int64, n)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros((n, width + 1), np.int64), np.full((n, width + 1), -1, np.int64)
        for start in range(width):
            rows = np.flatnonzero(sizes > start)
            node, lone = np.zeros(len(rows), np.int64), np.zeros(n, bool)
            for end in range(start + 1, min(width, start + self.longest) + 1):
                c = codes[rows, end - 1]
                node = self.trie.step(node, c)
                live = (node >= 0) & (c > 0) & (sizes[rows] >= end)
                rows, node = rows[live], node[live]
                if not len(rows):
                    break
                k = self.trie.value[node]
                some = k >= 0
                r, k = rows[some], k[some]
                if end == start + 1:
                    lone[r] = True
                total = best[r, start] + self.score[k]
                better = total > best[r, end]
                r = r[better]
                best[r, end], back[r, end], piece[r, end] = total[better], start, k[better]
            r = np.flatnonzero((sizes > start) & ~lone)
            total = best[r, start] + self.beyond
            better = total > best[r, start + 1]
            r = r[better]
            best[r, start + 1], back[r, start + 1], piece[r, start + 1] = total[better], start, -1
        out = []
        for k, (end, froms, pieces) in enumerate(zip(sizes.tolist(), back.tolist(), piece.tolist())):
            path: list[int] = []
            while end:
                path[:0] = [pieces[end]] if pieces[end] >= 0 else self.as_bytes(chunks[k][froms[end]])
                end = froms[end]
            out.append(np.array(path, "<u4").tobytes())
        return out

    def learn(self, new: set[str]) -> None:
        short = [c for c in new if len(c) <= LONG]
        short.sort(key=len)
        for at in range(0, len(short), 8192):
            part = short[at : at + 8192]
            self.chunks.update(zip(part, self.best_paths(part)))
        self.chunks.update((c, np.array(self.best_path(c), "<u4").tobytes()) for c in new if len(c) > LONG)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text; an empty text has none."""
        split = [chunks_of(t) for t in texts]
        new = set().union(*split)
        fresh = new.difference(self.chunks)
        if len(self.chunks) + len(fresh) > REMEMBERED:
            self.chunks = {}
            fresh = new
        self.learn(fresh)
        look = self.chunks.__getitem__
        for chunks in split:
            yield b"".join(map(look, chunks))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: byte pieces form characters, markers become blanks, and the blank before the text goes. Control pieces are silent."""
        if not hasattr(self, "raw"):
            self.raw = [bytes([self.byte_of[k]]) if k in self.byte_of else b"" if k in self.control else t.replace(MARK, " ").encode("utf-8", "surrogatepass") for k, t in enumerate(self.text)]
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def chunks_of(text: str) -> list[str]:
    """Runs of markers, each with the letters after it."""
    if not text:
        return []
    words = (MARK + text.replace(" ", MARK)).split(MARK)
    if "" not in words[1:]:
        return [MARK + w for w in words[1:]]
    out, marks = [], ""
    for w in words[1:]:
        marks += MARK
        if w:
            out.append(marks + w)
            marks = ""
    return out + [marks] if marks else out


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces (pieces that stand for single bytes), ids_crc32 and round_trip (decoding gives the text back) of every row.

    A null or empty text has no pieces. A text that holds the marker itself comes back with a blank in its place, and is no round trip.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held_in_worker(f"pieces {model}", lambda: Pieces(model))
        low, high = coder.bytes_id[0], coder.bytes_id[-1]
        for batch in batches:
            rows: list[tuple] = []
            texts, chars = [], 0
            for n, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= SLICE or n == batch.num_rows - 1:
                    for t, raw in zip(texts, coder.encode(texts)):
                        ids = np.frombuffer(raw, "<u4")
                        rows.append((len(ids), int(((ids >= low) & (ids <= high)).sum()), zlib.crc32(raw), coder.decode(ids) == t))
                    texts, chars = [], 0
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))]], ["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "round_trip"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, round_trip boolean")


def public_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(documents(spark, sf_dir), public_pieces())
