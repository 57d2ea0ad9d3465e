"""Language-model scoring with a causal self-attention model over subword ids, trained in NumPy.

Words are cut into pieces of a public vocabulary by greedy longest match. The model gives the class of the next piece
from the pieces before it (one attention layer over a window of ``LENGTH``, with a residual path), and counts over the
whole training corpus give the piece within its class; classes are bands of frequency, kept apart for pieces that begin
a word and pieces that continue one. The score of a word is that of its pieces: no count of words or of pairs enters it,
so none has to be left out on a large corpus. Long texts are scored in windows that overlap, each piece once.

Training is data-parallel: in each round every task starts from the same weights, learns from every ``ROUNDS``-th window of
every training document in its partition, and the weights are averaged by what they have seen, in two levels of groups.
After the rounds every piece of every training text has been learnt from once, in the window in which it would be
scored. The counts, of words and of pieces, are sums over all training documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.llm import substring_dedup
from ledgerlore.llm.token_count import PIECES, START
from ledgerlore.session import materialise

LENGTH, STRIDE = 32, 24  # pieces in a window, and how far the next one lies
WIDTH, BANDS = 16, 20
ROUNDS = 2  # each takes one window in ROUNDS, another one each time
WINDOWS = 256  # windows in one batch
RATE = 0.02
FREQUENT = 1 << 20  # words with at least 1/FREQUENT of all tokens, so at most FREQUENT of them, travel to the tasks; the others are joined
END = 2
CHUNKS = 64
SLICE = 1 << 20  # bytes of text worked on at once
COUNTED = 1 << 21  # words that a task counts before it passes the counts on
LONG = 48  # bytes; longer words are taken apart one by one

SPACES = (9, 10, 11, 12, 13, 32)
SPACE = np.isin(np.arange(256), SPACES)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))
LETTER = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Pieces:
    """Words to piece ids by greedy longest match: many words at once step through a trie of the pieces' bytes."""

    def __init__(self, pieces: dict[str, int], in_bytes: list[int]):
        self.pieces, self.in_bytes = pieces, np.array(in_bytes, np.int32)
        self.longest = max(map(len, pieces), default=1)
        nodes: list[dict[int, int]] = [{}]
        ids = [-1]
        for piece, number in pieces.items():
            at = 0
            for byte in piece.encode():
                if byte not in nodes[at]:
                    nodes[at][byte] = len(nodes)
                    nodes.append({})
                    ids.append(-1)
                at = nodes[at][byte]
            ids[at] = number
        begin = 0
        for byte in START.encode():
            begin = nodes[begin].get(byte, 0) if begin or byte == START.encode()[0] else 0
        # Nodes with children come first, so that the others need no row. Column 0 is that of bytes no piece has.
        inner = [i for i, node in enumerate(nodes) if node]
        order = inner + [i for i, node in enumerate(nodes) if not node]
        of = np.empty(len(nodes), np.int32)
        of[order] = np.arange(len(nodes))
        used = sorted({byte for node in nodes for byte in node} - set(SPACES))
        self.column = np.zeros(256, np.intp)
        self.column[used] = np.arange(1, len(used) + 1)
        self.n_columns = len(used) + 1
        self.table = np.zeros(len(inner) * self.n_columns, np.int32)
        for row, i in enumerate(inner):
            for byte, child in nodes[i].items():
                self.table[row * self.n_columns + self.column[byte]] = of[child] if self.column[byte] else 0
        self.table[:: self.n_columns] = 0
        self.ids = np.array(ids, np.int32)[order]
        self.inner = len(inner)
        self.begin = int(of[begin]) if begin and nodes[begin] and ids[begin] >= 0 else -1

    def one(self, word: bytes) -> list[int]:
        """The ids of one word, piece after piece."""
        text, out, at = START + word.decode(), [], 0
        while at < len(text):
            for end in range(min(len(text), at + self.longest), at, -1):
                number = self.pieces.get(text[at:end])
                if number is not None:
                    out.append(number)
                    break
            else:
                end = at + 1
                out.extend(self.in_bytes[list(text[at].encode())].tolist())
            at = end
        return out

    def of_words(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the words at ``first`` in ``data``, each followed by white space, end to end; and their numbers."""
        room = size + 1 if self.begin >= 0 else size + 3  # a piece takes a byte at least, but for the mark
        base = np.cumsum(room) - room
        out = np.full(int(room.sum()), -1, np.int32)
        long = size > LONG if self.begin >= 0 else np.ones(len(size), bool)
        for i in np.flatnonzero(long).tolist():
            ids = self.one(data[first[i] : first[i] + size[i]].tobytes())
            out[base[i] : base[i] + len(ids)] = ids
        lanes = np.flatnonzero(~long)
        pos, slot = first[lanes], base[lanes]
        shift = slot + 1 - pos  # from the place of a byte to the slot of the piece that begins there
        node = np.full(len(lanes), self.begin, np.intp)
        best = np.full(len(lanes), self.ids[self.begin], np.int32)
        best_pos = pos.copy()
        while len(pos):
            child = self.table[node * self.n_columns + self.column[data[pos]]]
            number = self.ids[child]
            pos = pos + 1
            hit = number >= 0
            best = np.where(hit, number, best)
            best_pos = np.where(hit, pos, best_pos)
            node = child.astype(np.intp)
            done = np.flatnonzero((child == 0) | (child >= self.inner))
            if not len(done):
                continue
            found, to = best[done], best_pos[done]
            none = np.flatnonzero(found < 0)
            if len(none):  # no piece begins here: the byte
                at = slot[done[none]] - shift[done[none]]
                found[none] = self.in_bytes[data[at]]
                to[none] = at + 1
            out[slot[done]] = found
            pos[done] = to
            best_pos[done] = to
            slot[done] = to + shift[done]
            node[done], best[done] = 0, -1
            over = done[SPACE[data[to]]]
            if len(over):
                left = np.ones(len(pos), bool)
                left[over] = False
                pos, slot, shift, node, best, best_pos = (x[left] for x in (pos, slot, shift, node, best, best_pos))
        filled = out >= 0
        return out[filled], np.add.reduceat(filled, base, dtype=np.int64) if len(base) else np.empty(0, np.int64)


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of several texts, where their words begin and end, codes of the words, and how many words a text has.

    Words are split at ASCII white space, with A-Z in lower case. A code is a polynomial over the word's bytes.
    """
    data = np.frombuffer(b" " + b"\n".join(texts).lower() + b"\n", np.uint8)
    edges = np.diff(SPACE[data].view(np.int8))
    first, last = np.flatnonzero(edges == -1) + 1, np.flatnonzero(edges == 1) + 1
    sums = np.cumsum(LETTER[data] * np.cumprod(np.full(len(data), FACTOR)))
    # Times the power that brings every word to the same place, which is the inverse of that of its first byte.
    back = np.cumprod(np.full(len(data), INVERSE))[first]
    codes = C.signed(C.mixed((sums[last - 1] - sums[first - 1]) * back + (last - first).astype(np.uint64)))
    stops = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64)) + 1
    return data, first, last, codes, np.diff(np.searchsorted(first, stops), prepend=0)


class Words:
    """The words of several texts: ``codes`` of the distinct ones, which each one is (``at``), how many a text has
    (``n``), and where each distinct one first stands (``first``, ``size``) in ``data``."""

    def __init__(self, texts: list[bytes]):
        self.data, first, last, each, self.n = split_words(texts)
        self.codes, at, self.at = np.unique(each, return_index=True, return_inverse=True)
        self.first, self.size = first[at], (last - first)[at]


def vocabulary(path: str = PIECES) -> tuple[dict[str, int], list[int], np.ndarray]:
    """Piece to id, the ids of the bytes, and for each id whether it begins a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, in_bytes, begins = {}, [0] * 256, np.zeros(model.get_piece_size(), bool)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            in_bytes[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i)):
            pieces[piece] = i
            begins[i] = piece.startswith(START)
    return pieces, in_bytes, begins


def classes(counts: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each id, and log10 of its probability in the class, from piece counts plus one."""
    smooth = counts + 1.0
    of = np.zeros(len(counts), np.int64)
    for family, first in ((begins, 0), (~begins, BANDS)):
        ids = np.flatnonzero(family)
        ids = ids[np.argsort(-smooth[ids], kind="stable")]
        mass = np.cumsum(np.sqrt(smooth[ids]))
        of[ids] = first + np.minimum((mass / mass[-1] * BANDS).astype(np.int64), BANDS - 1)
    of[END] = 2 * BANDS
    total = np.bincount(of, weights=smooth, minlength=2 * BANDS + 1)
    return of, np.log10(smooth / total[of])


class Attention:
    """One causal attention layer with a residual path; weights are a list of arrays in single precision."""

    def __init__(self, weights: list[np.ndarray]):
        self.w = weights
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []  # by_id, once asked for
        self.mask = np.tril(np.ones((LENGTH, LENGTH), np.float32))

    @staticmethod
    def fresh(size: int) -> list[np.ndarray]:
        rng = np.random.default_rng(3)
        shapes = [(size, WIDTH), (LENGTH, WIDTH), (WIDTH, 3 * WIDTH), (WIDTH, WIDTH), (WIDTH, 2 * BANDS + 1), (2 * BANDS + 1,)]
        scales = [0.3, 0.1, WIDTH**-0.5, 0.1, WIDTH**-0.5, 0.0]
        return [(rng.normal(size=s) * k).astype(np.float32) for s, k in zip(shapes, scales)]

    def scaled(self) -> np.ndarray:
        """The weights of queries, keys and values; queries come out divided by the root of their size."""
        qkv = self.w[2].copy()
        qkv[:, :WIDTH] *= WIDTH**-0.5
        return qkv

    def by_id(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """What queries, keys, values and the layer's input are, as a sum of a part for the id and one for the place."""
        qkv = self.scaled()
        both = [[w, *np.split(w @ qkv, 3, axis=1)] for w in self.w[:2]]
        return [(np.ascontiguousarray(a), np.ascontiguousarray(b)) for a, b in zip(*both)]

    def attend(self, q: np.ndarray, turned: np.ndarray, v: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The weights before they are divided by their sums, the sums, and what attention gives the queries, which are
        those of the places from ``begin`` on."""
        s = q @ turned
        if s.max(initial=0) > 30:
            np.minimum(s, 30, out=s)
        np.exp(s, out=s)
        s *= self.mask[begin : begin + q.shape[1], : v.shape[1]]
        total = (s.reshape(-1, v.shape[1]) @ np.ones(v.shape[1], np.float32)).reshape(*s.shape[:2], 1)
        a = s @ v
        a /= total
        return s, total, a

    def odds(self, h: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By classes and the rows of ``h``: the odds of each class, up to a factor of the row; their sums; the
        logarithm of those of the target classes."""
        logits = self.w[4].T @ h.T
        logits += self.w[5][:, None]
        if logits.size and max(logits.max(), -logits.min()) > 60:
            logits -= logits.max(axis=0)
        picked = logits[target, np.arange(len(h))]
        np.exp(logits, out=logits)
        return logits, logits.sum(axis=0), picked

    def log_probability(self, ids: np.ndarray, target: np.ndarray, scored: np.ndarray) -> np.ndarray:
        """Natural log of the probability of the target classes at the scored places; zero elsewhere."""
        out = np.zeros(ids.shape, np.float32)
        self.tables = self.tables or self.by_id()
        for rows, begin, stop in parts(scored):
            some = ids[rows, :stop]
            x, q, k, v = (
                t.take(some[:, first:], axis=0) + p[first:stop] for (t, p), first in zip(self.tables, (begin, begin, 0, 0))
            )
            _, _, a = self.attend(q, np.ascontiguousarray(k.transpose(0, 2, 1)), v, begin)
            x += (a.reshape(-1, WIDTH) @ self.w[3]).reshape(a.shape)
            _, total, picked = self.odds(x.reshape(-1, WIDTH), target[rows, begin:stop].ravel())
            out[rows, begin:stop] = (picked - np.log(total)).reshape(a.shape[:2])
        return out

    def learn(self, ids: np.ndarray, target: np.ndarray, scored: np.ndarray, state: list[np.ndarray]) -> None:
        """One step of Adagrad on the mean log loss of the scored places."""
        n = int(scored.sum())
        if not n:
            return
        self.tables = []
        steps = [np.zeros_like(w) if i else None for i, w in enumerate(self.w)]
        dx = np.zeros((*ids.shape, WIDTH), np.float32)
        for rows, begin, stop in parts(scored):
            dx[rows, :stop] += self.gradient(ids[rows], target[rows, begin:stop].ravel(), scored[rows, begin:stop].ravel() / np.float32(n), begin, stop, steps)
        steps[1] += dx.sum(axis=0)
        for i in range(1, 6):
            state[i] += steps[i] ** 2
            self.w[i] -= RATE * steps[i] / np.sqrt(state[i] + 1e-10)
        table, flat_ids = self.w[0], ids.ravel()
        order = np.argsort(flat_ids.astype(np.uint16) if len(table) <= 1 << 16 else flat_ids, kind="stable")
        in_order = flat_ids[order]
        new = np.diff(in_order, prepend=-1) != 0
        seen, at = in_order[new], np.empty(len(order), np.intp)
        at[order] = np.cumsum(new) - 1
        g = np.empty((len(seen), WIDTH), np.float32)
        for i, column in enumerate(dx.reshape(-1, WIDTH).T.astype(np.float64, order="C")):
            g[:, i] = np.bincount(at, weights=column)
        squares = state[0].take(seen, axis=0) + g**2
        state[0][seen] = squares
        table[seen] -= RATE * g / np.sqrt(squares + 1e-10)

    def gradient(self, ids: np.ndarray, target: np.ndarray, weight: np.ndarray, begin: int, stop: int, steps: list) -> np.ndarray:
        """The gradient at the layer's input, given the weight of each place in the loss; those of the weights are
        added to ``steps``."""
        table, places, _, out, head, _ = self.w
        qkv = self.scaled()
        x = table.take(ids[:, :stop], axis=0)
        x += places[:stop]
        wide = x.reshape(-1, WIDTH)
        q, k, v = np.split((wide @ qkv).reshape(*x.shape[:2], 3 * WIDTH), 3, axis=2)
        q, k = np.ascontiguousarray(q[:, begin:]), np.ascontiguousarray(k)
        s, total, a = self.attend(q, np.ascontiguousarray(k.transpose(0, 2, 1)), v, begin)
        heads = a.reshape(-1, WIDTH)
        h = heads @ out
        h.reshape(a.shape)[...] += x[:, begin:]
        odds, sums, _ = self.odds(h, target)
        odds *= weight / sums
        odds[target, np.arange(len(target))] -= weight
        dh = (head @ odds).T
        # What the weights sum to in the gradient of the softmax is the product with what attention gave. It stands as
        # one more column here, and a row of ones below, so that one product does both.
        da = np.empty((*a.shape[:2], WIDTH + 1), np.float32)
        da[:, :, :WIDTH] = (dh @ out.T).reshape(a.shape)
        da[:, :, WIDTH:] = (da[:, :, :WIDTH] * a) @ np.full((WIDTH, 1), -1, np.float32)
        da /= total
        turned = np.ones((len(x), WIDTH + 1, stop), np.float32)
        turned[:, :WIDTH] = v.transpose(0, 2, 1)
        ds = da @ turned
        ds *= s
        d = np.empty((*x.shape[:2], 3 * WIDTH), np.float32)
        d[:, :begin, :WIDTH] = 0
        d[:, begin:, :WIDTH] = ds @ k
        d[:, :, WIDTH : 2 * WIDTH] = ds.transpose(0, 2, 1) @ q
        d[:, :, 2 * WIDTH :] = s.transpose(0, 2, 1) @ np.ascontiguousarray(da[:, :, :WIDTH])
        d = d.reshape(-1, 3 * WIDTH)
        change = wide.T @ d
        change[:, :WIDTH] *= WIDTH**-0.5
        steps[2] += change
        steps[3] += heads.T @ dh
        steps[4] += (odds @ h).T
        steps[5] += odds @ np.ones(len(target), np.float32)
        dx = (d @ qkv.T).reshape(x.shape)
        dx[:, begin:] += dh.reshape(a.shape)
        return dx


def parts(scored: np.ndarray) -> Iterator[tuple[np.ndarray | slice, int, int]]:
    """(windows, from, to) of the places that count: what a window has in common with the one before counts only in
    the first of a text, so it is not asked for in the others."""
    for begin, stop in ((0, LENGTH - STRIDE), (LENGTH - STRIDE, LENGTH)):
        rows = np.flatnonzero(scored[:, begin:stop].any(axis=1))
        if len(rows):
            yield slice(None) if len(rows) == len(scored) else rows, begin, stop


def window_numbers(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the windows of texts of so many pieces: which text, and which window of it."""
    n = np.maximum(0, -(-(lengths - LENGTH) // STRIDE)) + 1
    owner = np.repeat(np.arange(len(lengths)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of so many pieces, laid end to end: positions of each window's places, which are real, which count."""
    owner, number = window_numbers(lengths)
    place = number[:, None] * STRIDE + np.arange(LENGTH)
    real = place < lengths[owner][:, None]
    counts = real & ((number[:, None] == 0) | (np.arange(LENGTH) >= LENGTH - STRIDE))
    start = (np.cumsum(lengths) - lengths)[owner][:, None]
    return start + np.minimum(place, lengths[owner][:, None] - 1), real, counts


def taken(lengths: np.ndarray, shifts: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a round: positions of their places, and which count. In ``ROUNDS`` rounds each window comes once."""
    owner, number = window_numbers(lengths)
    at, _, scored = windows(lengths)
    mine = (number + shifts[owner]) % ROUNDS == turn
    return at[mine], scored[mine]


def piece_stream(words: Words, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of texts, each closed by the end mark, end to end; and their numbers."""
    ids, n = pieces.of_words(words.data, words.first, words.size)
    ids, n = np.append(ids, np.int32(END)), np.append(n, 1)
    ends = np.cumsum(words.n)
    order = np.insert(words.at, ends, len(n) - 1)
    each = n[order]
    offset = np.cumsum(each) - each
    flat = ids[np.repeat((np.cumsum(n) - n)[order] - offset, each) + np.arange(int(each.sum()))]
    closed = ends + np.arange(len(ends))  # places of the end marks
    return flat, np.diff(offset[closed] + 1, prepend=0)


def inputs_of(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What stands before each piece; the end mark stands before a text."""
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[np.cumsum(lengths) - lengths] = END
    return before


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(train: DataFrame) -> DataFrame:
    """``(code, n)`` over the words of all training texts, partial counts per task first; the ends are not in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(kept), return_counts=True)
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64))], names=["code", "n"])

        for batch in C.byte_slices(batches, 0, SLICE):
            kept.append(split_words(C.byte_texts(batch.column(0)))[3])
            if sum(map(len, kept)) > COUNTED:
                yield flush()
        if kept:
            yield flush()

    text = F.col("text").cast("string").alias("text")
    return train.select(text).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def joined(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of several texts (binary) end to end, and their numbers."""
    texts = column.to_pylist()
    return np.frombuffer(b"".join(texts), kind).astype(np.int32), np.array([len(t) for t in texts], np.int64) // np.dtype(kind).itemsize


class Corpus:
    """``rows`` (doc_id, text, perhaps held_out) as pieces, and what is learnt from those not held out: counts of words and pieces, and the weights."""

    def __init__(self, rows: DataFrame, path: str = PIECES):
        spark = rows.sparkSession
        if "held_out" not in rows.columns:
            rows = rows.select("doc_id", "text", held_out().alias("held_out"))
        train = rows.where(~F.col("held_out"))
        context = spark.sparkContext
        vocab = vocabulary(path)
        self.vocab = context.broadcast(vocab)
        self.size = len(vocab[2])
        self.kind = np.uint16 if self.size <= 1 << 16 else np.int32
        self.words = materialise(word_counts(train), "words")
        ends = train.count()
        distinct, total = self.words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        self.tokens, self.distinct, self.ends = total + ends, distinct + (ends > 0), ends
        often = self.words.where(F.col("n") * FREQUENT >= self.tokens).select("code", "n").toArrow()
        codes = often["code"].to_numpy()
        order = np.argsort(codes)
        self.frequent = context.broadcast((codes[order], often["n"].to_numpy()[order].astype(np.int64)))
        self.rows = materialise(self.taken_apart(rows), "lm", dense=True)
        self.pieces = self.rows.where(~F.col("held_out")).select("shift", "pieces")
        self.piece_counts = self._piece_counts()
        self.class_of, self.in_class = classes(self.piece_counts, vocab[2])
        self.weights = Attention.fresh(self.size)
        for number in range(ROUNDS):
            self.weights = self._round(number)

    def taken_apart(self, rows: DataFrame) -> DataFrame:
        """``(doc_id, held_out, shift, n_tokens, known, sums, rare, pieces)`` of ``rows`` (doc_id, text, held_out): what
        frequent words add to the base score, the codes of the other words, and the pieces with the end mark. ``shift``
        gives the window that a text begins with in a round; it follows from the id."""
        vocab, frequent, dtype = self.vocab, self.frequent, self.kind
        names = ["doc_id", "held_out", "shift", "n_tokens", "known", "sums", "rare", "pieces"]

        def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces = None
            for batch in C.byte_slices(batches, 0, SLICE):
                pieces = pieces or Pieces(*vocab.value[:2])
                words, rows = Words(C.byte_texts(batch.column(0))), batch.num_rows
                count = counts_of(words.codes, frequent.value)[words.at]
                owner, often = np.repeat(np.arange(rows), words.n), count > 0
                known = np.bincount(owner[often], minlength=rows)
                sums = np.bincount(owner[often], weights=np.log10(count[often] + 1.0), minlength=rows)
                rare = substring_dedup.split(words.codes[words.at[~often]], owner[~often], rows)
                flat, lengths = piece_stream(words, pieces)
                stops = np.cumsum(lengths)
                flat = flat.astype(dtype)
                texts = [flat[a:b].tobytes() for a, b in zip(stops - lengths, stops)]
                columns = [pa.array(words.n + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns, rare, pa.array(texts, pa.binary())], names=names)

        shift = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)).cast("int").alias("shift")
        kind = "doc_id long, held_out boolean, shift int, n_tokens long, known long, sums double, rare array<long>, pieces binary"
        return rows.select(F.col("text").cast("string").alias("text"), "doc_id", "held_out", shift).mapInArrow(take_apart, kind)

    def _piece_counts(self) -> np.ndarray:
        size, dtype = self.size, self.kind

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(size, np.int64)
            for batch in batches:
                counts += np.bincount(joined(batch.column(0), dtype)[0], minlength=size)
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["piece", "n"])

        rows = self.pieces.select("pieces").mapInArrow(count, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(size, np.int64)
        counts[rows["piece"].to_numpy()] = rows["n"].to_numpy()
        return counts

    def _round(self, number: int) -> list[np.ndarray]:
        """Weights averaged over the tasks, each from the same start; the start where nothing was learnt."""
        start = self.pieces.sparkSession.sparkContext.broadcast((self.weights, self.class_of))
        dtype = self.kind

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, class_of = start.value
            model = Attention([w.copy() for w in weights])
            state = [np.zeros_like(w) for w in weights]
            seen = 0
            for batch in C.arrow_rows(batches, 100):
                flat, lengths = joined(batch.column(1), dtype)
                at, scored = taken(lengths, batch.column(0).to_numpy(), number)
                ids, target = inputs_of(flat, lengths), class_of[flat]
                for i in range(0, len(at), WINDOWS):
                    part = slice(i, i + WINDOWS)
                    model.learn(ids[at[part]], target[at[part]], scored[part], state)
                seen += int(scored.sum())
            if seen:
                flat = np.concatenate([w.ravel() for w in model.w]).astype(np.float64) * seen
                task = TaskContext.get().partitionId()
                chunks = np.array_split(flat, CHUNKS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(CHUNKS), pa.int32()),
                        pa.array([task] * CHUNKS, pa.int32()),
                        pa.array([float(seen)] * CHUNKS),
                        C.lists(chunks, pa.float64()),
                    ],
                    names=["chunk", "task", "seen", "v"],
                )

        def add(group: pa.Table) -> pa.Table:
            group = group.sort_by("task")  # so that a repeated run adds in the same order
            total = np.sum(C.list_rows(group["v"], np.float64), axis=0)
            return pa.table(
                {
                    "chunk": group["chunk"][:1],
                    "task": group["task"][:1],
                    "seen": pa.array([sum(group["seen"].to_pylist())]),
                    "v": C.lists([total], pa.float64()),
                }
            )

        kind = "chunk int, task int, seen double, v array<double>"
        parts = self.pieces.mapInArrow(learn, kind)
        sums = parts.groupBy("chunk", F.pmod("task", F.lit(64))).applyInArrow(add, kind).groupBy("chunk").applyInArrow(add, kind).toArrow()
        if not sums.num_rows:
            return self.weights
        order = np.argsort(sums["chunk"].to_numpy())
        values = C.list_rows(sums["v"], np.float64)
        flat = np.concatenate([values[i] for i in order]) / sums["seen"][0].as_py()
        cuts = np.cumsum([w.size for w in self.weights])[:-1]
        return [p.reshape(w.shape).astype(np.float32) for p, w in zip(np.split(flat, cuts), self.weights)]


def counts_of(codes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The counts of frequent words; minus one for others."""
    known, n = frequent
    if not len(known):
        return np.full(len(codes), -1, np.int64)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[at] == codes, n[at], -1)


def text_scores(
    flat: np.ndarray, lengths: np.ndarray, model: Attention, class_of: np.ndarray, in_class: np.ndarray
) -> np.ndarray:
    """log10 of the probability of each piece; every piece is scored in one window."""
    at, _, scored = windows(lengths)
    before = inputs_of(flat, lengths)
    target = class_of[flat]
    value = in_class[flat]
    for i in range(0, len(at), WINDOWS):
        places, rows = at[i : i + WINDOWS], scored[i : i + WINDOWS]
        value[places[rows]] += model.log_probability(before[places], target[places], rows)[rows] / np.log(10)
    return value


def lm_scores(docs: DataFrame, path: str = PIECES) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``.

    ``base_score`` is the add-one unigram score of the words and the end; ``score`` the model's log10 probability. A
    null or blank text is the end alone. A null id is not held out. Repeated rows give repeated results. With no
    training rows all counts are zero and the model is the untrained one. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out"))
    corpus = Corpus(rows, path)
    context = docs.sparkSession.sparkContext
    shipped = context.broadcast((corpus.weights, corpus.class_of, corpus.in_class))
    dtype, columns = corpus.kind, ["doc_id", "held_out", "n_tokens", "known", "sums", "key"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, class_of, in_class = shipped.value
        model = Attention(weights)
        for batch in C.arrow_rows(batches, 100):
            flat, lengths = joined(batch.column(len(columns)), dtype)
            scores = text_scores(flat, lengths, model, class_of, in_class)
            scores = np.add.reduceat(scores, np.cumsum(lengths) - lengths) if len(lengths) else scores
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*columns, "score"])

    keyed = corpus.rows.withColumn("key", F.xxhash64("doc_id", "n_tokens", "sums", "rare", "pieces"))
    kind = "doc_id long, held_out boolean, n_tokens long, known long, sums double, key long, score double"
    scored = materialise(keyed.select(*columns, "pieces").mapInArrow(score, kind), "lm")
    # Words that are not frequent meet their counts; none of them is a large share of the rows.
    rare = keyed.select("key", F.explode("rare").alias("code"))
    found = rare.join(corpus.words.where(F.col("n") * FREQUENT < corpus.tokens), "code").groupBy("key")
    more = found.agg(F.sum(F.log10(F.col("n") + 1.0)).alias("more"), F.count(F.lit(1)).alias("more_known"))
    copies = scored.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    more = more.join(copies, "key").select("key", (F.col("more") / F.col("copies")).alias("more"), (F.col("more_known") / F.col("copies")).cast("long").alias("more_known"), "copies")
    out = C.join_groups(scored, materialise(more, "lm"), "key", "copies", "left")
    base = F.log10(F.lit(float(corpus.tokens + corpus.distinct + 1)))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(int(corpus.ends > 0))).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (
            F.col("sums") + F.coalesce("more", F.lit(0.0)) + F.log10(F.lit(corpus.ends + 1.0)) - F.col("n_tokens") * base
        ).alias("base_score"),
        "score",
    )
