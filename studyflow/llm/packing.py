"""Best-fit packing of tokenized documents into sequences by bin completion.

Tasks tokenize whole texts and cut what is longer than a sequence. Only the number of pieces of each length reaches the driver (at most as many
rows as a sequence has tokens). There, bin completion works on these counts: around the longest piece left it searches the undominated fillings
(fewest and longest pieces first), takes the one with the least waste as often as the counts allow, and ends with a branch and bound over all
undominated fillings of the last pieces, pruned by the waste that the lower bound leaves. Best-fit decreasing is the incumbent; while a plan
misses the lower bound, further descents set the longest pieces apart. Up to ``LAST_PIECES`` pieces the search is the whole plan, and exact
unless its nodes run out. The plan is a list of runs "the pieces of
this length with ranks from .. to .. go to the sequences from .. at offset ..", at most a few for each length and filling, whatever the number
of documents. Ranks are counted per (length, bucket), so no length is one task's work.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from studyflow.llm.merges import LONGEST, Merges
from studyflow.llm.shared import documents, held_in_worker
from studyflow.session import staged

SEQUENCE = 2048
# Chunks of text, and words without their marks, whose ids a worker remembers; when full, it keeps those it has just met.
REMEMBERED = 250_000
# Marks that close a word; the tokenizer parts them from its letters, and none of them is in a special token or a contraction.
CLOSING = ".,;:!?%&$#*)-\""
# Characters of text that are split at a time.
SLICE = 4_000_000
# Nodes of one search for a filling and of the last branch and bound; beyond, the best found so far is taken.
NODES = 20_000
LAST_PIECES = 40
# Pieces up to which every undominated filling is tried.
EVERY_FILLING = 24
# Cuts of the first row of descents that set the longest pieces apart.
DESCENTS = 16
# Rows that one (length, bucket) holds on average at most, if a single length has them all.
BUCKET_ROWS = 50_000


class Known:
    """Token ids of strings, as two columns. When full, it keeps those it was just asked for."""

    def __init__(self):
        self.keys, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def of(self, words: pa.Array, learn: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The ids of each word; ``learn`` gives those of distinct unknown ones."""
        coded = words.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.keys)
        new, held = coded.dictionary.filter(at.is_null()), at.drop_null()
        place = at.fill_null(-1).to_numpy().copy()
        unknown = place < 0
        # Texts with more words than are remembered are learned whole; of the others, those of these texts stay.
        if len(self.keys) + len(new) > REMEMBERED:
            self.keys, self.ids = self.keys.take(held), self.ids.take(held)
            place[~unknown] = np.arange(len(held))
        if len(new):
            place[unknown] = len(self.keys) + np.arange(len(new))
            self.ids = pa.concat_arrays([self.ids, learn(new)])
            self.keys = pa.concat_arrays([self.keys, new])
        return self.ids.take(pa.array(place)).take(coded.indices)


class ChunkIds:
    """Token ids of texts, by chunks between blanks (the tokenizer drops white space and never joins across it).

    A chunk of letters with closing marks is looked up by its lower-case letters and its marks, which the tokenizer splits apart too.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges(path)
        self.chunks, self.letters, self.marks = Known(), Known(), Known()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def wholes(self, texts: pa.Array) -> pa.Array:
        return pa.array([self.whole(t) for t in texts.to_pylist()], pa.large_binary())

    def learn_letters(self, words: pa.Array) -> pa.Array:
        short = pc.less_equal(pc.binary_length(words), LONGEST)
        ids = [pa.array(self.merges.encode(words.filter(short).cast(pa.large_binary()).to_pylist()), pa.large_binary()), self.wholes(words.filter(pc.invert(short)))]
        return in_order(ids, [short.to_numpy(zero_copy_only=False)])

    def learn(self, chunks: pa.Array) -> pa.Array:
        from unicodedata import is_normalized

        cores = pc.ascii_rtrim(chunks, characters=CLOSING)
        plain = pc.ascii_is_alpha(cores).to_numpy(zero_copy_only=False)
        letters, at = [pc.ascii_lower(cores.filter(pa.array(plain)))], np.flatnonzero(~plain)
        more = []
        for core in cores.take(pa.array(at)).to_pylist():
            wide = core.isalpha() and not core.isascii() and is_normalized("NFC", core) and "Σ" not in core and "İ" not in core
            more.append(core.lower() if wide else None)
        letters.append(pa.array(more, pa.large_string()).drop_null())
        wide = np.zeros(len(chunks), bool)
        wide[at] = [core is not None for core in more]
        known = in_order([self.letters.of(pa.concat_arrays(letters), self.learn_letters), self.wholes(chunks.filter(pa.array(~plain & ~wide)))], [plain, wide])
        # The marks of what was looked up by its letters.
        closed = (plain | wide) & pc.not_equal(pc.binary_length(chunks), pc.binary_length(cores)).to_numpy(zero_copy_only=False)
        marked = pa.array(closed)
        ends = [c[n:] for c, n in zip(chunks.filter(marked).to_pylist(), pc.utf8_length(cores.filter(marked)).to_pylist())]
        ends = self.marks.of(pa.array(ends, pa.large_string()), self.wholes)
        joined = pc.binary_join_element_wise(known.filter(marked), ends, pa.scalar(b"", pa.large_binary()))
        return in_order([joined, known.filter(pc.invert(marked))], [closed])

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        found = self.chunks.of(split.flatten(), self.learn)
        data = found.buffers()[2] or pa.py_buffer(b"")
        cuts = np.frombuffer(found.buffers()[1], np.int64)[found.offset :][split.offsets.to_numpy()].tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield data[a:b].to_pybytes()


def in_order(parts: list[pa.Array], masks: list[np.ndarray]) -> pa.Array:
    """One column of ``parts``: first the rows of each mask, then those of none."""
    places = [np.flatnonzero(m) for m in masks]
    order = np.concatenate([*places, np.flatnonzero(~np.logical_or.reduce(masks))])
    return pa.concat_arrays(parts).take(pa.array(np.argsort(order)))


def token_pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece; a document is its ids and the id 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held_in_worker(f"ids {tokenizer}", lambda: ChunkIds(tokenizer))
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            texts, first, chars = [], 0, 0
            for n, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= SLICE or n == len(ids) - 1:
                    for doc, raw in zip(ids[first:], coder.ids(texts)):
                        raw += b"\0\0\0\0"
                        for k, at in enumerate(range(0, len(raw), 4 * size)):
                            part = raw[at : at + 4 * size]
                            rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                    texts, first, chars = [], n + 1, 0
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


Filling = tuple[int, ...]


def best_fit(counts: np.ndarray, size: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on counts by length: (lengths of a sequence, number of such sequences)."""
    room: dict[int, list[tuple[Filling, int]]] = {}
    free = np.zeros(size + 1, np.int64)
    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            fit = np.flatnonzero(free[length:])
            if len(fit):
                gap = int(fit[0]) + length
                filling, n = room[gap].pop()
                used = min(n, left)
                if n > used:
                    room[gap].append((filling, n - used))
                free[gap] -= used
            else:
                gap, filling = size, ()
                used = max(1, left // (size // length))
            room.setdefault(gap - length, []).append((filling + (length,), used))
            free[gap - length] += used
            left -= used
    return [x for group in room.values() for x in group]


def fewest(counts: np.ndarray, size: int) -> int:
    """Lower bound of the number of sequences: the best of three.

    The tokens; the pieces over a half with those that fit beside none of them (for every cut); and rounded lengths: of pieces over j / (k + 1)
    of a sequence each k / j fit at most, so they weigh j / k.
    """
    lengths = np.arange(size + 1)
    tokens = np.cumsum(counts * lengths)
    half, upto = size // 2, np.cumsum(counts)
    low = np.arange(0, half + 1)
    over, big = int(upto[size] - upto[half]), upto[size] - upto[size - low]
    small = tokens[half] - np.where(low > 0, tokens[np.maximum(low, 1) - 1], 0)
    room = (over - big) * size - (tokens[size - low] - tokens[half])
    bound = max(-(-int(tokens[size]) // size), over + max(0, int((-((room - small) // size)).max())))
    there = np.flatnonzero(counts)
    for k in range(2, 21):
        parts = there * (k + 1)
        weights = np.where(parts % size == 0, parts // size * k, parts // size * (k + 1))
        bound = max(bound, -(-int((weights * counts[there]).sum()) // (k * (k + 1))))
    return bound


def fillings(counts: np.ndarray, gap: int, nodes: int = NODES, most: int = 4) -> list[Filling]:
    """The best fillings of ``gap`` from what is left, least waste first, then fewest and longest pieces (those are not dominated)."""
    there = np.flatnonzero(counts[: gap + 1] > 0)[::-1]
    if not len(there):
        return [()]
    if counts[gap] > 0:
        return [(gap,)]
    found: dict[Filling, int] = {}
    least = [gap]
    visited = 0

    def go(taken: Filling, left: int, at: int, depth: int) -> bool:
        """True ends the search: nothing is left of the gap."""
        nonlocal visited
        visited += 1
        if left and depth:
            rest = there[np.searchsorted(-there, -left) :] if left < gap else there
            rest = rest[rest <= at] if at < left else rest
            for x in rest.tolist():
                if visited > nodes:
                    break
                if counts[x] <= taken.count(x):
                    continue
                if depth == 1:
                    found[taken + (x,)] = left - x
                    least[0] = min(least[0], left - x)
                    visited += 1
                    return left == x
                if x * depth < left - least[0]:
                    break
                if go(taken + (x,), left - x, x, depth - 1):
                    return True
        if taken:
            found[taken] = left
            least[0] = min(least[0], left)
        return left == 0

    for depth in range(1, most + 1):
        if go((), gap, gap, depth):
            break
    # What is left beside a filling takes the longest pieces that fit.
    grown: dict[Filling, int] = {}
    for taken, left in sorted(found.items(), key=lambda x: (x[1], len(x[0])))[:8]:
        while left:
            fit = [x for x in there[np.searchsorted(-there, -left) :].tolist() if counts[x] > taken.count(x)][:1]
            if not fit:
                break
            n = min(int(counts[fit[0]]) - taken.count(fit[0]), left // fit[0])
            taken, left = taken + (fit[0],) * n, left - n * fit[0]
        grown[tuple(sorted(taken, reverse=True))] = left
    return sorted(grown, key=lambda t: (grown[t], len(t), tuple(-x for x in t)))


def undominated(left: dict[int, int], gap: int) -> list[Filling]:
    """All fillings of ``gap`` that no other is at least as good as, least waste first.

    Dominated is a filling beside which a further piece fits, or in which a longer piece fits in the place of one or of two of its pieces:
    what it would set free goes to where that piece would be.
    """
    there = sorted((x for x, n in left.items() if n and x <= gap), reverse=True)
    after = [sum(x * left[x] for x in there[k:]) for k in range(len(there) + 1)]
    found: list[tuple[int, Filling]] = []

    def closed(taken: Filling, waste: int) -> bool:
        pairs = {a + b for k, a in enumerate(taken) for b in taken[k + 1 :]}
        spare = [x for x in there if left[x] > taken.count(x)]
        return not any(any(y < x <= y + waste for y in taken) or any(y <= x <= y + waste for y in pairs) for x in spare)

    def go(taken: Filling, waste: int, k: int, skipped: int) -> None:
        if waste - after[k] >= skipped:
            return
        if k == len(there):
            if closed(taken, waste):
                found.append((waste, taken))
            return
        x = there[k]
        most = min(left[x], waste // x)
        for n in range(most, -1, -1):
            go(taken + (x,) * n, waste - n * x, k + 1, x if n < left[x] else skipped)

    go((), gap, 0, gap + 1)
    return [t for _, t in sorted(found, key=lambda f: (f[0], len(f[1]), tuple(-x for x in f[1])))]


def last_pieces(counts: np.ndarray, size: int, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Branch and bound over few pieces: a branch ends when the bound of what is left leaves nothing to gain; what was left before is not tried anew."""
    best = best_fit(counts, size)
    fewest_found, bound, visited = sum(n for _, n in best), fewest(counts, size), 0
    seen: dict[tuple, int] = {}

    def go(left: np.ndarray, made: list[Filling]) -> bool:
        """True ends the search: the bound is met, or the nodes are used up."""
        nonlocal best, fewest_found, visited
        visited += 1
        there = np.flatnonzero(left)
        if not len(there):
            if len(made) < fewest_found:
                best, fewest_found = [(f, 1) for f in made], len(made)
            return fewest_found == bound
        if visited > nodes:
            return True
        state = (*there.tolist(), *left[there].tolist())
        if seen.get(state, size * len(counts)) <= len(made) or len(made) + fewest(left, size) >= fewest_found:
            return False
        seen[state] = len(made)
        top = int(there[-1])
        rest = left.copy()
        rest[top] -= 1
        few = int(rest.sum()) <= EVERY_FILLING
        tried = undominated({x: int(rest[x]) for x in there.tolist()}, size - top) if few else fillings(rest, size - top, 2000)
        for filling in tried:
            after = rest.copy()
            np.subtract.at(after, list(filling), 1)
            if go(after, [*made, (top, *filling)]):
                return True
        return False

    if fewest_found > bound:
        go(counts.astype(np.int64), [])
    return best


def completed(counts: np.ndarray, size: int, apart: int) -> list[tuple[Filling, int]]:
    """One descent: around the longest piece left, the undominated filling with the least waste, as often as the counts allow.

    Pieces over ``apart`` take each other first, and only then what fits beside them: the short pieces, which fill sequences of more pieces, are
    not spent on them.
    """
    left, plan = counts.astype(np.int64).copy(), []
    while int(left.sum()) > LAST_PIECES:
        rest = left.copy()
        filling, gap = (), size
        while gap > apart or not filling:
            fit = np.flatnonzero(rest[apart + 1 if filling else 0 : gap + 1])
            if not len(fit):
                break
            filling += (int(fit[-1]) + (apart + 1 if filling else 0),)
            rest[filling[-1]] -= 1
            gap -= filling[-1]
            if filling[0] <= apart:
                break
        if gap:
            filling += fillings(rest, gap)[0]
        kinds, each = np.unique(filling, return_counts=True)
        times = int((left[kinds] // each).min())
        left[kinds] -= each * times
        plan.append((filling, times))
    return plan + last_pieces(left, size, NODES if not plan else NODES // 20)


def sequences(plan: list[tuple[Filling, int]]) -> int:
    return sum(n for _, n in plan)


def complete(counts: np.ndarray, size: int) -> list[tuple[Filling, int]]:
    """(lengths of a sequence, number of such sequences) for ``counts`` pieces by length.

    The incumbents are best-fit decreasing and the plain descent. While they miss the lower bound, further descents set the longest pieces apart:
    first from cuts at every ``1 / DESCENTS`` of the pieces, then from cuts around the best one.
    """
    bound = fewest(counts, size)
    best = best_fit(counts, size)
    upto = np.cumsum(counts)

    def better(apart: int) -> int:
        nonlocal best
        plan = completed(counts, size, apart)
        best = min(best, plan, key=sequences)
        return sequences(plan)

    if sequences(best) > bound:
        better(size)
    tried: dict[int, int] = {}
    step = DESCENTS
    cuts = [k / step for k in range(1, step)]
    for _ in range(3):
        for share in cuts:
            apart = int(np.searchsorted(upto, share * int(upto[-1])))
            if sequences(best) > bound and apart not in tried and apart > 0:
                tried[apart] = better(apart)
        if sequences(best) == bound or not tried:
            break
        middle = int(upto[min(tried, key=tried.get)]) / max(1, int(upto[-1]))
        step *= 4
        cuts = [middle + k / step for k in (-3, -2, -1, 1, 2, 3)]
    return best


def runs(plan: list[tuple[Filling, int]], size: int) -> dict[str, np.ndarray]:
    """The plan as runs, sorted by length and first rank."""
    ranks, rows, sequence = np.zeros(size + 1, np.int64), [], 0
    for filling, times in plan:
        offset = 0
        for length in filling:
            rows.append((length, int(ranks[length]), sequence, offset))
            ranks[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T))


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece; the plan's sequences and their lower bound.

    A null or empty text is the id 0 alone. Repeated rows are packed each. A null id stays null. No rows give none.
    """
    pieces = staged(token_pieces(docs, tokenizer, size, id_col, text_col), "pieces")
    found = pieces.groupBy("length").count().collect()
    counts = np.zeros(size + 1, np.int64)
    for row in found:
        counts[row["length"]] = row["count"]
    made = complete(counts, size)
    plan, n_sequences, bound = runs(made, size), sequences(made), fewest(counts, size)
    buckets = max(16, int(counts.sum()) // BUCKET_ROWS)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    ranked = dealt.withColumn("place", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece"))).join(before, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place") - 1).alias("rank"))
    key = plan["length"] << 44 | plan["rank"] if len(plan["length"]) else np.zeros(0, np.int64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rank = pdf.pop("rank").to_numpy()
            at = np.searchsorted(key, pdf["length"].to_numpy() << 44 | rank, side="right") - 1
            yield pdf.assign(sequence_id=plan["sequence"][at] + rank - plan["rank"][at], offset=plan["offset"][at], n_sequences=n_sequences, least_sequences=bound)

    return ranked.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, n_sequences long, least_sequences long")


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizer())
