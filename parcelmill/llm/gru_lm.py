"""Language-model scoring with a gated recurrent network and a class-factored softmax.

Counts of all words come from all training rows. The most frequent words form the network's vocabulary and
fall into classes of about equal mass; every other word is one `unknown` word of the network, times its share
among the other words. The output layer starts as the unigram model of all training rows. The network then
learns, in numpy, by back-propagation truncated at windows, from every training document once: in each round
the tasks learn from the documents of one hash class, then their weights are averaged. For
scoring, documents run through the network side by side, each whole: its state is carried across windows.
"""

import heapq
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.llm.common import crc32_of, utf8, written

#: Words of the network's vocabulary, their classes, and the width of its state.
VOCABULARY, CLASSES, WIDTH = 2047, 40, 16
#: Rounds of learning: each training document is learned from in one of them.
ROUNDS = 4
#: Window and rows of the truncated back-propagation, and of scoring.
WINDOW, ROWS, RATE = 16, 256, 0.4
FIRST_SQUARE = 1e-5
SCORE_WINDOW, SCORE_ROWS = 64, 256
#: Tokens that one task learns from in a round: fewer would average weights that have hardly moved.
TASK_TOKENS = 500_000
#: Tokens (and documents) that a task holds at a time. A vocabulary of less than 2 ** 16 words fits ids of two bytes.
HELD_TOKENS, HELD_DOCS = 3_000_000, 3000
END = b""
_LAST = 2**63 - 1


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words (A-Z only) and one end."""
    return [*utf8(text).lower().split(), END]


# --- counts of all words, and sums of each document -------------------------------------------------


_CHUNK = "chunk long, word binary, place int, train long, postings binary"
_CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), ("word", pa.binary()), ("place", pa.int32()), ("train", pa.int64()), ("postings", pa.binary())])


def words_by_text(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts laid end to end, and how many of them each text has; ends are not among them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    found = lists.flatten()
    real = pc.binary_length(found).to_numpy(zero_copy_only=False) > 0
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return found.filter(pa.array(real)).cast(pa.binary()), np.bincount(owner[real], minlength=len(lists))


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in chunks of bounded size: a row for each word of a chunk, and one with the chunk's postings."""
    parts: list[tuple] = []
    size = held = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            words, sizes = words_by_text(part.column(2))
            keys = np.stack([part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)], 1)
            parts.append((keys, part.column(3).to_numpy(zero_copy_only=False), words, sizes))
            held, size = held + part.num_rows, size + len(words)
            if held >= HELD_DOCS or size >= HELD_TOKENS // 2:
                yield from _chunk(parts)
                parts, size, held = [], 0, 0
    if parts:
        yield from _chunk(parts)


def _chunk(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Words by their place in the chunk; the postings are each document's places and how often they occur."""
    chunk = uuid.uuid4().int >> 65
    keys, learned, sizes = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 3))
    coded = pa.chunked_array([*(p[2] for p in parts), pa.array([END], pa.binary())]).dictionary_encode().chunks
    words = coded[0].dictionary  # that of all chunks; the end comes last, as no word is empty
    docs, kinds = np.arange(len(sizes)), len(words)
    places = np.concatenate([c.indices.to_numpy() for c in coded])[:-1]
    pairs, ns = np.unique(np.concatenate([np.repeat(docs, sizes) * kinds + places, docs * kinds + kinds - 1]), return_counts=True)
    docs, ids = np.divmod(pairs, kinds)
    train = np.bincount(ids, ns * learned[docs], kinds).astype(np.int64)
    for at in range(0, kinds, 20_000):
        part = words.slice(at, 20_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(part), chunk)), part, pa.array(np.arange(at, at + len(part), dtype=np.int32)),
             pa.array(train[at : at + len(part)]), pa.nulls(len(part), pa.binary())],
            schema=_CHUNK_SCHEMA,
        )
    plain = io.BytesIO()
    np.savez(plain, ids=ids.astype(np.int32), ns=ns.astype(np.int32), sizes=np.bincount(docs, minlength=len(sizes)), keys=keys)
    packed = zstandard.compress(plain.getvalue(), 3)
    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((chunk, None, None, 0, packed), _CHUNK_SCHEMA.types, strict=True)], schema=_CHUNK_SCHEMA)


_SUMS = "doc_key long, text_key long, base_score double, tail double, n_known long"


def _sums(total: int, kinds: int, rest: int, rest_kinds: int):
    """Per document of a chunk the sums over its tokens, from the chunk's postings and its words' counts."""

    def sums(postings: pa.Table, words: pa.Table) -> pa.Table:
        with np.load(io.BytesIO(zstandard.decompress(postings.column("postings")[0].as_py()))) as packed:
            ids, ns, sizes, keys = (packed[k] for k in ("ids", "ns", "sizes", "keys"))
        place = words.column("place").to_numpy()
        c, inside = np.zeros(len(place)), np.zeros(len(place), bool)
        c[place], inside[place] = words.column("c").to_numpy(), words.column("in_network").to_numpy()
        docs, n = np.repeat(np.arange(len(sizes)), sizes), len(sizes)
        each = np.log10(c + 1)
        base = each - np.log10(total + kinds + 1.0)
        tail = np.where(inside, 0, each - np.log10(rest + rest_kinds + 1.0))
        return pa.table(
            {"doc_key": keys[:, 0], "text_key": keys[:, 1], "base_score": np.bincount(docs, ns * base[ids], n), "tail": np.bincount(docs, ns * tail[ids], n),
             "n_known": np.bincount(docs, ns * (c > 0)[ids], n).astype(np.int64)}
        )

    return sums


# --- the network ------------------------------------------------------------------------------------


class Network:
    """A gated recurrent unit. Word ids are 0 .. n - 1 by falling count, the last is the unknown word."""

    def __init__(self, words: list[bytes], counts: np.ndarray, seed: int = 11):
        mass = np.append(counts[:-1], max(counts[-1], 0)).astype(np.float64) + 1
        n = len(mass)
        self.words, self.n = words, n
        # classes of about equal mass over the sorted words; the unknown word has one of its own
        share = np.cumsum(mass[:-1]) / max(mass[:-1].sum(), 1)
        of = np.unique(np.minimum((share * (CLASSES - 1)).astype(int), CLASSES - 2), return_inverse=True)[1] if n > 1 else np.zeros(0, int)
        self.of = np.append(of, of.max(initial=-1) + 1).astype(np.int16)
        k = int(self.of[-1]) + 1
        self.begin = np.searchsorted(self.of, np.arange(k + 1))
        per_class = np.bincount(self.of, mass, k)
        rng, h = np.random.default_rng(seed), WIDTH
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.p = {
            "x": small(n, 3 * h), "u": small(h, 3 * h), "wc": small(h, k) * 0, "bc": np.log(per_class / mass.sum()).astype(np.float32),
            "wo": small(n, h) * 0, "bo": np.log(mass / per_class[self.of]).astype(np.float32),
        }
        self.p["x"][:, :h] += 1.0  # keep state at first
        self.restart()
        self.ids = {w: i for i, w in enumerate(words)}
        self.first = self.ids.get(END, n - 1)

    def restart(self) -> None:
        """Forget the sums of squared gradients that the steps are divided by."""
        self.squares = {k: np.full_like(v, FIRST_SQUARE) for k, v in self.p.items()}

    def encode(self, text: str | None) -> np.ndarray:
        get, unknown = self.ids.get, self.n - 1
        return np.array([get(t, unknown) for t in tokens(text)], np.int32)

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """As `encode`, for all texts at once."""
        words, sizes = words_by_text(texts)
        ids = pc.index_in(words, value_set=pa.array(self.words, pa.binary())).fill_null(self.n - 1).to_numpy()
        return np.split(np.insert(ids, np.cumsum(sizes), self.first), np.cumsum(sizes + 1)[:-1])

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            size = self.p[k].size
            self.p[k] = flat[at : at + size].reshape(self.p[k].shape).astype(np.float32)
            at += size
        self.restart()

    def output(self, h: np.ndarray, target: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probabilities of targets given states (m, width), and what flows back into the states."""
        p, of = self.p, self.of[target]
        e = h @ p["wc"]
        e += p["bc"]
        np.exp(e, out=e)  # logits stay near those of the unigram model: no overflow
        total = e @ np.ones(e.shape[1], np.float32)
        m = np.arange(len(h))
        out = e[m, of] / total
        back = None
        if grads is not None:
            d = np.divide(e, total[:, None], out=e)
            d[m, of] -= 1
            grads["wc"], grads["bc"] = h.T @ d, d.sum(axis=0)
            grads["wo"], grads["bo"] = np.zeros_like(p["wo"]), np.zeros_like(p["bo"])
            back = d @ p["wc"].T
        order = np.argsort(of, kind="stable")
        borders = np.searchsorted(of[order], np.arange(len(self.begin)))
        for c in range(len(self.begin) - 1):
            a, b = self.begin[c], self.begin[c + 1]
            rows = order[borders[c] : borders[c + 1]]
            if b - a < 2 or not len(rows):
                continue  # a word alone in its class is certain there
            own = h[rows]
            e = own @ p["wo"][a:b].T
            e += p["bo"][a:b]
            np.exp(e, out=e)
            total = e @ np.ones(b - a, np.float32)
            r, t = np.arange(len(rows)), target[rows] - a
            out[rows] *= e[r, t] / total
            if grads is not None:
                d = np.divide(e, total[:, None], out=e)
                d[r, t] -= 1
                grads["wo"][a:b], grads["bo"][a:b] = d.T @ own, d.sum(axis=0)
                back[rows] += d @ p["wo"][a:b]
        return np.log(np.maximum(out, 1e-37)), back

    def learn(self, given: np.ndarray, target: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One step over a window (time, rows); `fresh` marks where a document begins. The state after it."""
        p, w, (steps, rows) = self.p, WIDTH, given.shape
        x, u, back_u = p["x"][given], p["u"], np.ascontiguousarray(p["u"].T)
        starts = fresh.any(axis=1)
        before, states, new, gated = (np.empty((steps, rows, w), np.float32) for _ in range(4))
        gates = np.empty((steps, rows, 2 * w), np.float32)
        for t in range(steps):
            h0 = before[t]
            h0[:] = h
            if starts[t]:
                h0[fresh[t]] = 0
            g = h0 @ u
            zr = np.add(x[t, :, : 2 * w], g[:, : 2 * w], out=gates[t])
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            gated[t] = g[:, 2 * w :]
            n = np.multiply(zr[:, w:], gated[t], out=new[t])
            n += x[t, :, 2 * w :]
            np.tanh(n, out=n)
            h = np.subtract(h0, n, out=states[t])
            h *= zr[:, :w]
            h += n
        grads: dict[str, np.ndarray] = {}
        back = self.output(states.reshape(-1, w), target.ravel(), grads)[1].reshape(steps, rows, w)
        z, r = gates[:, :, :w], gates[:, :, w:]
        # what a change of a state does to both gates and to the new state, for all steps at once
        to_new = (1 - z) * (1 - new * new)
        to_update = (before - new) * z * (1 - z)
        to_reset = gated * r * (1 - r)
        inner, into = (np.empty((steps, rows, 3 * w), np.float32) for _ in range(2))
        down = np.zeros((rows, w), np.float32)
        for t in reversed(range(steps)):
            down += back[t]
            dn = np.multiply(down, to_new[t], out=into[t, :, 2 * w :])
            np.multiply(down, to_update[t], out=inner[t, :, :w])
            np.multiply(dn, to_reset[t], out=inner[t, :, w : 2 * w])
            np.multiply(dn, r[t], out=inner[t, :, 2 * w :])
            down *= z[t]
            down += inner[t] @ back_u
            if starts[t]:
                down[fresh[t]] = 0
        into[:, :, : 2 * w] = inner[:, :, : 2 * w]
        grads["u"] = before.reshape(-1, w).T @ inner.reshape(-1, 3 * w)
        order = np.argsort(given, axis=None, kind="stable")
        words = given.ravel()[order]
        begins = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        words = words[begins]
        grads["x"] = np.add.reduceat(into.reshape(-1, 3 * w)[order], begins, axis=0)
        for k, g in grads.items():
            at = words if k == "x" else slice(None)  # only the rows of words that were given change
            g = np.clip(g / target.size, -1, 1)
            squares = self.squares[k][at] + g * g
            self.squares[k][at] = squares
            p[k][at] -= RATE * g / np.sqrt(squares)
        return h

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each document, whole."""
        streams = sorted(_streams(docs, SCORE_ROWS), key=lambda s: -sum(len(docs[d]) for d in s))
        laid = [self._laid(docs, s) for s in streams]
        lengths = np.array([len(target) for _, target, _, _ in laid], np.int64)
        p, w = self.p, WIDTH
        half = np.concatenate([np.full(2 * w, 0.5), np.ones(w)]).astype(np.float32)
        x, u = p["x"] * half, p["u"] * half
        h = np.zeros((len(streams), w), np.float32)
        out = np.zeros(len(docs))
        for at in range(0, int(lengths.max(initial=0)), SCORE_WINDOW):
            # only a window of the streams that reach it is laid side by side, so one long text takes no more room
            reach = int(np.searchsorted(-lengths, -at, "left"))
            given, target, owner = (np.zeros((SCORE_WINDOW, reach), np.int32) for _ in range(3))
            fresh = np.zeros((SCORE_WINDOW, reach), bool)
            for s in range(reach):
                for wide, row in zip((given, target, fresh, owner), laid[s], strict=True):
                    part = row[at : at + SCORE_WINDOW]
                    wide[: len(part), s] = part
            states, widths = [], []
            for t in range(min(SCORE_WINDOW, int(lengths[0]) - at)):
                live = int(np.searchsorted(-lengths, -(at + t), "left"))  # streams longer than that stand first
                h0 = h[:live]
                if fresh[t, :live].any():
                    h0[fresh[t, :live]] = 0
                a = x[given[t, :live]]
                g = h0 @ u
                zr = np.tanh(a[:, : 2 * w] + g[:, : 2 * w])
                zr += 1
                zr *= 0.5
                g[:, 2 * w :] *= zr[:, w:]
                n = np.tanh(a[:, 2 * w :] + g[:, 2 * w :])
                h0 -= n
                h0 *= zr[:, :w]
                h0 += n
                states.append(h0.copy())
                widths.append(live)
            flat, owners = (np.concatenate([m[k, :live] for k, live in enumerate(widths)]) for m in (target, owner))
            found = self.output(np.concatenate(states), flat)[0]
            out += np.bincount(owners, weights=found, minlength=len(docs))
        return out

    def _laid(self, docs: list[np.ndarray], members: list[int]) -> tuple[np.ndarray, ...]:
        """Given and wanted words, first words and documents of a stream of documents laid end to end."""
        target = np.concatenate([docs[d] for d in members]).astype(np.int32)
        sizes = [len(docs[d]) for d in members]
        begins = np.cumsum([0, *sizes[:-1]])
        given, fresh = np.roll(target, 1), np.zeros(len(target), bool)
        given[begins], fresh[begins] = self.first, True
        return given, target, fresh, np.repeat(np.array(members, np.int32), sizes)

    def train(self, docs: list[np.ndarray]) -> None:
        """One pass over documents laid end to end and cut into rows of equal length.

        All rows are filled in every window, so that no document is learned from alone. A document that a cut
        divides starts with a new state after it; the last row is filled up with the first tokens.
        """
        if not docs:
            return
        docs = [docs[k] for k in np.random.default_rng(5).permutation(len(docs))]
        target, begins = np.concatenate(docs), np.cumsum([0, *map(len, docs[:-1])])
        given, fresh = np.roll(target, 1), np.zeros(len(target), bool)
        given[begins], fresh[begins] = self.first, True
        rows = max(1, min(ROWS, len(target) // WINDOW))
        length = -(-len(target) // rows)
        given, target, fresh = (np.resize(v, rows * length).reshape(rows, length).T.copy() for v in (given, target, fresh))
        fresh[0] = True
        h = np.zeros((rows, WIDTH), np.float32)
        for at in range(0, length, WINDOW):
            w = slice(at, at + WINDOW)
            h = self.learn(given[w], target[w], fresh[w], h)


def _streams(docs: list[np.ndarray], rows: int) -> list[list[int]]:
    """Documents dealt to rows of about equal length, longest first."""
    rows = max(1, min(rows, len(docs)))
    heap = [(0, r) for r in range(rows)]
    out: list[list[int]] = [[] for _ in range(rows)]
    for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        size, r = heapq.heappop(heap)
        out[r].append(d)
        heapq.heappush(heap, (size + len(docs[d]), r))
    return out


# --- learning in all tasks, and scoring ---------------------------------------------------------------

_PARTS, _SALTS = 32, 64


def _learner(network, flat):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen, docs, size = network.value, 0, [], 0
        net.load(flat.value)
        for batch in batches:
            for ids in batch.column(0):
                docs.append(np.frombuffer(ids.as_py(), np.uint16))
                size += len(docs[-1])
                if size >= HELD_TOKENS // 8:
                    net.train(docs)
                    seen, docs, size = seen + size, [], 0
        net.train(docs)
        seen += size
        if seen:
            # the same when a lost task runs again, so that no part is counted twice or left out
            salt = TaskContext.get().partitionId() % _SALTS
            parts = np.array_split(net.flat().astype(np.float32), _PARTS)
            yield pa.RecordBatch.from_pylist(
                [{"part": k, "salt": salt, "tokens": float(seen), "weights": v.tobytes()} for k, v in enumerate(parts)],
                schema=pa.schema([("part", pa.int32()), ("salt", pa.int32()), ("tokens", pa.float64()), ("weights", pa.binary())]),
            )

    return learn


def _mean(rows: pa.Table) -> pa.Table:
    """The mean of parts of weights, each counted by its tokens."""
    total, out = 0.0, None
    for n, w in zip(rows.column("tokens").to_pylist(), rows.column("weights").to_pylist(), strict=True):
        part = np.frombuffer(w, np.float32).astype(np.float64) * n
        total, out = total + n, part if out is None else out + part
    return pa.table({"part": rows.column("part")[:1], "salt": rows.column("salt")[:1], "tokens": [total], "weights": [(out / total).astype(np.float32).tobytes()]})


def _encoder(network):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [d.astype(np.uint16).tobytes() for d in network.value.encode_all(part.column(4))]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(ids, pa.binary())], ["doc_id", "doc_key", "text_key", "learned", "ids"])

    return encode


def _scorer(network, flat):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network.value
        net.load(flat.value)
        rows, docs, size = [], [], 0

        def done() -> Iterator[pa.RecordBatch]:
            held = pa.Table.from_batches(rows)
            held = held.append_column("n_tokens", pa.array([len(d) for d in docs], pa.int64()))
            return iter(held.append_column("network_score", pa.array(net.score(docs) / np.log(10))).combine_chunks().to_batches())

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows.append(part.select(["doc_id", "doc_key", "text_key", "learned"]))
                docs += [np.frombuffer(d.as_py(), np.uint16) for d in part.column("ids")]
                size += sum(map(len, docs[-part.num_rows :]))
                if size >= HELD_TOKENS:
                    yield from done()
                    rows, docs, size = [], [], 0
        if docs:
            yield from done()

    return score


def learning_rows(rows: DataFrame, k: int) -> DataFrame:
    """The training rows of round `k`; every training row is in one round."""
    return rows.filter(F.col("learned") & (F.pmod(F.xxhash64("doc_key", "text_key"), F.lit(ROUNDS)) == k))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """Per row `doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`.

    Rows whose CRC-32 of the id has the remainder `held` by `folds` are held out: nothing is learned from
    them. A null text counts as empty, one end. Rows of equal id and text get equal results. Other columns are
    left out; no rows give no rows. Where no row may be learned from, N and V are 0.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("doc_key"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_key"),
        F.col(text).alias("text"),
        (crc32_of(doc_id) % folds != held).alias("learned"),
    )
    chunks = written(rows.select("doc_key", "text_key", "text", "learned").mapInArrow(_chunk_rows, _CHUNK), "lm-chunks")
    words, postings = chunks.filter("word is not null").select("word", "chunk", "place"), chunks.filter("word is null").select(F.col("chunk").alias("of"), "postings")
    counts = written(chunks.filter("train > 0").groupBy("word").agg(F.sum("train").alias("c")), "lm-counts")
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("c"), "word").limit(VOCABULARY).collect()
    rest, rest_kinds = total - sum(r["c"] for r in top), kinds - len(top)
    # at most VOCABULARY words: bounded, so the broadcast is
    known = F.broadcast(spark.createDataFrame([(r["word"], True) for r in top], "word binary, in_network boolean"))
    counted = (
        words.join(counts.join(known, "word", "left"), "word", "left")
        .select("chunk", "place", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("in_network", F.lit(False)).alias("in_network"))
    )
    summed = postings.groupBy("of").cogroup(counted.groupBy("chunk")).applyInArrow(_sums(total, kinds, rest, rest_kinds), _SUMS)
    sums = summed.groupBy("doc_key", "text_key").agg(*[F.max(k).alias(k) for k in ("base_score", "tail", "n_known")])

    network = Network([bytes(r["word"]) for r in top], np.array([*[r["c"] for r in top], rest], np.float64))
    shared, flat = spark.sparkContext.broadcast(network), network.flat()
    # texts are turned into ids of two bytes once; learning and scoring read those
    encoded = rows.select("doc_id", "doc_key", "text_key", "learned", "text").mapInArrow(
        _encoder(shared), "doc_id long, doc_key long, text_key long, learned boolean, ids binary"
    )
    encoded = written(encoded, "lm-encoded")
    shape = "part int, salt int, tokens double, weights binary"
    for k in range(ROUNDS):
        now = spark.sparkContext.broadcast(flat)
        own = learning_rows(encoded, k).select("ids").coalesce(max(1, int(total) // ROUNDS // TASK_TOKENS))
        parts = own.mapInArrow(_learner(shared, now), shape)
        mean = parts.groupBy("part", "salt").applyInArrow(_mean, shape).groupBy("part").applyInArrow(_mean, shape).orderBy("part").collect()
        if mean:
            flat = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in mean])
    final = spark.sparkContext.broadcast(flat)
    scored = encoded.mapInArrow(
        _scorer(shared, final), "doc_id long, doc_key long, text_key long, learned boolean, n_tokens long, network_score double"
    )
    return scored.join(sums, ["doc_key", "text_key"]).select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        "base_score", (F.col("network_score") + F.col("tail")).alias("score"),
    )
