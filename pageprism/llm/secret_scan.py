"""Secrets in texts: fixed patterns, and a character network over every candidate and its surroundings."""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.llm.common import column_bytes, groups_by_bytes, map_batches, table

KINDS = ("assign", "access", "hex", "network")
#: Patterns of the base kinds, the shortest values, and keywords that a text with an assignment holds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
LEAST = {"assign": 6, "access": 20, "hex": 24}
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: A candidate is a whole run of these characters, of this length at least, with a digit in it.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
CANDIDATE_CHARS = 12

CONTEXT = 24
SYMBOLS = 98
FILTERS = 24
WIDTH = 5
#: Findings of a shard: one shard is trained at once; more are trained apart in rounds, each from the mean of all.
SHARD = 4000
ROUNDS = 4
ROUND_EPOCHS = 3
RECALL = 0.99
HELD_OUT = 4
TRAIN_CHARS = 512  # of a candidate in training; scoring takes whole candidates

_SPAN = "array<struct<kind:string,start:long,end:long>>"
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind; ordered by start, then kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if any("0" <= c <= "9" for c in m[0])]


_CLASS = np.zeros(256, np.int8)
_CLASS[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-", np.uint8)] = 1
_DIGIT = np.zeros(256, np.int32)
_DIGIT[48:58] = 1


def may_hold(texts: list[bytes]) -> list[bool]:
    """Whether a text can hold a pattern or a candidate: a quick test that never misses one."""
    return [ok for a, b in groups_by_bytes(texts) for ok in _may_hold(texts[a:b])]


def _may_hold(texts: list[bytes]) -> list[bool]:
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    edge = np.diff(_CLASS[joined], prepend=0, append=0)
    starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    digits = np.concatenate([[0], np.cumsum(_DIGIT[joined])])
    run = (ends - starts >= CANDIDATE_CHARS) & (digits[ends] > digits[starts])
    begins = np.concatenate([[0], np.cumsum(np.array([len(t) + 1 for t in texts]))])
    has_run = np.zeros(len(texts), bool)
    has_run[np.searchsorted(begins, starts[run], "right") - 1] = True
    # letters alone: a hexadecimal run of a-f, a key of capitals, or an assigned word
    plain = (ends - starts >= 20) & ~run
    has_run[np.searchsorted(begins, starts[plain], "right") - 1] = True
    return [bool(r) or any(k in low for k in KEYWORDS) for r, low in zip(has_run, (t.lower() for t in texts))]


def codes(text: str) -> np.ndarray:
    """Printable ASCII as 1-95, every other character as 96; 0 is padding."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where((points >= 32) & (points < 127), points - 31, 96)


def encode(text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a candidate with its surroundings, and which of them belong to it."""
    a, b = max(0, start - CONTEXT), min(len(text), end + CONTEXT)
    inside = np.zeros(b - a, bool)
    inside[start - a:end - a] = True
    return codes(text[a:b]), inside


@dataclass
class Network:
    """Convolution over characters, maximum over positions, one hidden layer; and the calibration of its output."""

    embed: np.ndarray   # (symbols x inside, channels)
    kernel: np.ndarray  # (width x channels, filters)
    bias: np.ndarray
    dense: np.ndarray   # (filters, hidden)
    dense_bias: np.ndarray
    out: np.ndarray     # hidden
    out_bias: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0  # above every probability: an untrained network adds nothing
    precision: float = float("nan")  # at the threshold, from the held-out findings weighted to the rates of the labels in the corpus

    @staticmethod
    def fresh(seed: int = 7, channels: int = 12, hidden: int = 16) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, np.sqrt(2 / shape[0]), shape)
        return Network(rng.normal(0, 0.5, (2 * SYMBOLS, channels)), draw(WIDTH * channels, FILTERS), np.zeros(FILTERS),
                       draw(FILTERS, hidden), np.zeros(hidden), draw(hidden), np.zeros(1))

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.kernel, self.bias, self.dense, self.dense_bias, self.out, self.out_bias]

    def pooled(self, symbols: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Maxima of the filters over a run of any length, piece by piece: memory doesn't grow with it."""
        index = symbols + SYMBOLS * inside
        pad = np.zeros(WIDTH // 2, np.int64)
        index = np.concatenate([pad, index, pad])
        best = np.full(FILTERS, -np.inf)
        for i in range(0, len(index) - WIDTH + 1, 4096):
            part = self.embed[index[i:i + 4096 + WIDTH - 1]]
            windows = np.lib.stride_tricks.sliding_window_view(part, WIDTH, axis=0).transpose(0, 2, 1).reshape(-1, WIDTH * part.shape[1])
            best = np.maximum(best, (windows @ self.kernel).max(0))
        return np.maximum(best + self.bias, 0)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled @ self.dense + self.dense_bias, 0) @ self.out + self.out_bias[0]

    def probabilities(self, items: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not items:
            return np.zeros(0)
        scores = self.logits(np.stack([self.pooled(*x) for x in items]))
        return 1 / (1 + np.exp(-(self.slope * scores + self.shift)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(items: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, seed: int = 7, rate: float = 4e-3,
        totals: tuple[int, int] = (1, 1)) -> Network:
    """Adam on cross-entropy with equal weight for both labels; every ``HELD_OUT``-th finding is kept apart and calibrates the output
    and the threshold. ``totals``: findings of labels 0 and 1 in the corpus. Only one label or none leaves a network that adds nothing."""
    net = Network.fresh(seed)
    labels = labels.astype(float)
    held = np.arange(len(labels)) % HELD_OUT == 0
    if min(labels[~held].sum(), (1 - labels[~held]).sum(), labels[held].sum(), (1 - labels[held]).sum()) == 0:
        return net
    weight = np.where(labels == 1, 0.5 / labels[~held].mean(), 0.5 / (1 - labels[~held].mean()))
    _descend(net, items, labels, weight, np.nonzero(~held)[0], epochs, seed, rate)
    kept = np.nonzero(held)[0]
    scores = net.logits(np.stack([net.pooled(*items[i]) for i in kept]))
    _calibrate(net, scores, labels[kept], totals)
    return net


def _descend(net: Network, items, labels, weight, own, epochs: int, seed: int, rate: float = 4e-3) -> None:
    """Epochs of Adam over the findings ``own``."""
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(own), max(1, len(own) // 32)):
            step += 1
            for p, (m, v), g in zip(net.parameters(), moments, _gradients(net, [items[i] for i in batch], labels[batch], weight[batch])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)


def _gradients(net: Network, items, labels, weight) -> list[np.ndarray]:
    longest = max(len(s) for s, _ in items) + WIDTH - 1
    index = np.zeros((len(items), longest), np.int64)
    for i, (symbols, inside) in enumerate(items):
        index[i, WIDTH // 2:WIDTH // 2 + len(symbols)] = symbols + SYMBOLS * inside
    x = net.embed[index]
    windows = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).transpose(0, 1, 3, 2)
    n, positions = windows.shape[:2]
    windows = windows.reshape(n, positions, -1)
    conv = windows @ net.kernel
    conv[np.arange(positions)[None, :] >= np.array([len(s) for s, _ in items])[:, None]] = -np.inf
    at = conv.argmax(1)
    best = np.take_along_axis(conv, at[:, None, :], 1)[:, 0] + net.bias
    pooled = np.maximum(best, 0)
    hidden = np.maximum(pooled @ net.dense + net.dense_bias, 0)
    d_logit = (_sigmoid(hidden @ net.out + net.out_bias[0]) - labels) * weight / n
    d_hidden = np.outer(d_logit, net.out) * (hidden > 0)
    d_best = (d_hidden @ net.dense.T) * (best > 0)
    chosen = windows[np.arange(n)[:, None], at]                  # item, filter, width x channels
    d_kernel = np.einsum("if,ifc->cf", d_best, chosen)
    d_windows = d_best[:, :, None] * net.kernel.T[None]
    d_embed = np.zeros_like(net.embed)
    channels = net.embed.shape[1]
    for k in range(WIDTH):
        np.add.at(d_embed, index[np.arange(n)[:, None], at + k], d_windows[:, :, k * channels:(k + 1) * channels])
    return [d_embed, d_kernel, d_best.sum(0), pooled.T @ d_hidden, d_hidden.sum(0), hidden.T @ d_logit, np.array([d_logit.sum()])]


def _calibrate(net: Network, scores: np.ndarray, labels: np.ndarray, totals: tuple[int, int] = (1, 1)) -> None:
    """Platt scaling by Newton steps with smoothed targets; then the highest threshold that still finds ``RECALL`` of the held-out secrets. Precision
    is a figure and moves nothing."""
    pos, neg = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    spread = scores.std() or 1.0
    z, w = (scores - scores.mean()) / spread, np.zeros(2)
    design = np.stack([z, np.ones_like(z)], 1)
    for _ in range(50):
        p = _sigmoid(design @ w)
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        w -= np.linalg.solve(hessian, design.T @ (p - target) + 1e-3 * w)
    net.slope, net.shift = w[0] / spread, w[1] - w[0] * scores.mean() / spread
    p = _sigmoid(net.slope * scores + net.shift)
    found = np.sort(p[labels == 1])
    net.threshold = float(found[int(np.floor((1 - RECALL) * len(found)))])
    true, false = (n * (p[labels == label] >= net.threshold).mean() for label, n in ((1, totals[1]), (0, totals[0])))
    net.precision = float(true / (true + false))


def _overlaps(spans, start: int, end: int) -> bool:
    return any(s < end and start < e for s, e, _ in spans)


def findings(docs: DataFrame) -> DataFrame:
    """Every candidate of every text with its surroundings, labelled 1 if a fixed pattern covers part of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_bytes(batch.column(0))
            labels, symbols, inside = [], [], []
            for text in (t.decode("utf-8", "replace") for t, ok in zip(texts, may_hold(texts)) if ok):
                spans = base_spans(text)
                for start, end in candidates(text):
                    s, i = encode(text, start, min(end, start + TRAIN_CHARS))
                    labels.append(int(_overlaps(spans, start, end)))
                    symbols.append(s.astype(np.uint8).tobytes())
                    inside.append(i.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(symbols, pa.binary()), pa.array(inside, pa.binary())],
                                             names=["label", "symbols", "inside"])

    return map_batches(docs.select(F.col("text").cast("string")), run, "label int, symbols binary, inside binary")


def _unpacked(symbols, inside) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(s, np.uint8).astype(np.int64), np.frombuffer(i, np.uint8).astype(bool)) for s, i in zip(symbols, inside)]


def train(docs: DataFrame, shard: int = SHARD, seed: int = 7) -> Network:
    """Network trained on all findings of all texts, each different finding once. Up to ``shard`` findings are trained at once; more are dealt by
    hash over shards of about this size, trained on the cluster."""
    found = findings(docs).withColumn("order", F.xxhash64("symbols", "inside"))
    split = found.groupBy("order").agg(F.first("label").alias("label"), F.first("symbols").alias("symbols"), F.first("inside").alias("inside"),
                                       F.count(F.lit(1)).alias("n"))
    from pageprism.session import stored

    split = stored(split, "findings")
    sums = split.groupBy("label").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different")).collect()
    n, different = {r.label: r.n for r in sums}, sum(r.different for r in sums)
    totals = (n.get(0, 0), n.get(1, 0))
    if different > shard:
        return _train_shards(split, -(-different // shard), totals, seed)
    rows = split.orderBy("order").collect()
    return fit(_unpacked([r.symbols for r in rows], [r.inside for r in rows]), np.array([r.label for r in rows]), seed=seed, totals=totals)


def _round(start, share: float, seed: int):
    """Epochs of one shard, from a broadcast network: its parameters times the number of findings learned."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows, net = rows.sort_values("order"), copy.deepcopy(start.value)
        labels = rows["label"].to_numpy(float)
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        _descend(net, _unpacked(rows["symbols"], rows["inside"]), labels, weight, np.arange(len(rows)), ROUND_EPOCHS, seed)
        flat = np.concatenate([p.ravel() for p in net.parameters()])
        return pd.DataFrame({"i": np.arange(len(flat)), "value": np.round(flat * (1 << 24)).astype(np.int64) * len(rows), "learned": len(rows)})

    return run


def _train_shards(split: DataFrame, shards: int, totals: tuple[int, int], seed: int) -> Network:
    """``fit`` on the cluster: in each round every shard trains from the mean of the last one. Parameters are added as whole multiples of 2^-24, so the
    result doesn't depend on the order. Calibration and threshold are those of all held-out findings."""
    from pageprism.session import stored

    # The hash deals the findings; whether one is held out comes from another part of it.
    dealt = split.withColumn("shard", F.pmod("order", F.lit(shards)).cast("int")).withColumn("held", F.pmod(F.xxhash64("order"), F.lit(HELD_OUT)) == 0)
    dealt = stored(dealt.select("shard", "order", "held", "label", "symbols", "inside"), "finding-shards")
    counts = {(r.held, r.label): r.n for r in dealt.groupBy("held", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    net = Network.fresh(seed)
    if len(counts) < 4:  # one label only, in training or apart
        return net
    share = counts[False, 1] / (counts[False, 0] + counts[False, 1])
    shapes = [p.shape for p in net.parameters()]
    # A given number of partitions: small shards would else be put together into few tasks.
    own = dealt.where("NOT held").drop("held").repartition(shards, "shard")
    context = split.sparkSession.sparkContext
    for number in range(ROUNDS):
        trained = own.groupBy("shard").applyInPandas(_round(context.broadcast(net), share, seed + number), "i long, value long, learned long")
        mean = trained.groupBy("i").agg((F.sum("value") / F.sum("learned") / (1 << 24)).alias("value")).orderBy("i").collect()
        flat, at = np.array([r.value for r in mean]), 0
        for p, shape in zip(net.parameters(), shapes):
            p[...] = flat[at:at + p.size].reshape(shape)
            at += p.size
    model = context.broadcast(net)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.pooled(*x) for x in _unpacked(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            logits = model.value.logits(np.stack(found)) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(logits, pa.float64())], names=["label", "score"])

    held = stored(map_batches(dealt.where("held").select("label", "symbols", "inside"), scores, "label int, score double"), "held-scores")
    _calibrate_table(net, held, totals)
    return net


def _calibrate_table(net: Network, held: DataFrame, totals: tuple[int, int]) -> None:
    """``_calibrate`` over a table of ``label, score``: sums of all rows for each Newton step, and the exact row at the threshold."""
    one = F.col("label") == 1
    s = held.agg(F.count_if(one).alias("pos"), F.count_if(~one).alias("neg"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("spread")).first()
    spread, w = s.spread or 1.0, np.zeros(2)
    z = (F.col("score") - s.mean) / spread
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.greatest(F.least(z * float(w[0]) + float(w[1]), F.lit(60.0)), F.lit(-60.0))))
        off = p - F.when(one, (s.pos + 1) / (s.pos + 2)).otherwise(1 / (s.neg + 2))
        h = p * (1 - p)
        r = held.agg(F.sum(h * z * z), F.sum(h * z), F.sum(h), F.sum(z * off), F.sum(off)).first()
        step = np.linalg.solve(np.array([[r[0], r[1]], [r[1], r[2]]]) + 1e-3 * np.eye(2), np.array([r[3], r[4]]) + 1e-3 * w)
        w -= step
        if abs(step).max() < 1e-9:
            break
    # Sums of tables differ in their last digits by the order of their rows.
    net.slope, net.shift = float(np.round(w[0] / spread, 6)), float(np.round(w[1] - w[0] * s.mean / spread, 6))
    logit = net.slope * F.col("score") + net.shift
    place = int(np.floor((1 - RECALL) * s.pos))
    positive = held.where(one).select(logit.alias("logit"), F.floor(logit * 64).alias("bin"))
    before = 0
    for r in positive.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).orderBy("bin").collect():
        if before + r.n > place:
            at = positive.where(F.col("bin") == r.bin).orderBy("logit").offset(place - before).limit(1).first().logit
            break
        before += r.n
    net.threshold = float(1 / (1 + np.exp(-at)))
    kept = held.agg(F.count_if(one & (logit >= at)).alias("true"), F.count_if(~one & (logit >= at)).alias("false")).first()
    true, false = totals[1] * kept.true / s.pos, totals[0] * kept.false / s.neg
    net.precision = float(true / (true + false))


def scan_text(text: str, net: Network) -> list[tuple[int, int, str]]:
    """All spans: those of the patterns, and candidates apart from them whose probability reaches the threshold."""
    spans = base_spans(text)
    open_ = [c for c in candidates(text) if not _overlaps(spans, *c)]
    found = net.probabilities([encode(text, *c) for c in open_])
    spans += [(s, e, "network") for (s, e), p in zip(open_, found) if p >= net.threshold]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def scan(docs: DataFrame, net: Network) -> DataFrame:
    """Given columns and ``secret_spans``: kind, start and end (code points, end exclusive) of every secret, in order.

    Every whole text is scanned and every candidate of it scored. A null or empty text has no spans; repeated rows are scanned each;
    a column of the same name is replaced; all others are kept.
    """
    names = [c for c in docs.columns if c != "secret_spans"]
    at = names.index("text")
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_bytes(batch.column(at))
            spans = [scan_text(t.decode("utf-8", "replace"), model.value) if ok else [] for t, ok in zip(texts, may_hold(texts))]
            column = pa.array([[{"kind": k, "start": s, "end": e} for s, e, k in own] for own in spans], _ARROW_SPAN)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*names, "secret_spans"])

    given = docs.select(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    return map_batches(given, run, f"{schema}, secret_spans {_SPAN}")


def redact(docs: DataFrame, net: Network, mark: str = "[SECRET]") -> DataFrame:
    """Documents with every secret replaced by ``mark``; overlapping spans are one. ``n_chars`` follows where it is a column."""
    names = docs.columns
    at = names.index("text")
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_bytes(batch.column(at))
            clean = batch.column(at).to_pylist()
            for i, ok in enumerate(may_hold(texts)):
                if ok:
                    clean[i] = replaced(clean[i], scan_text(clean[i], model.value), mark)
            columns = list(batch.columns)
            columns[at] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    done = map_batches(docs.withColumn("text", F.col("text").cast("string")),
        run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else done


def replaced(text: str, spans, mark: str) -> str:
    parts, at = [], 0
    for start, end, _ in spans:
        if end > at:
            if start >= at:
                parts += [text[at:start], mark]
            at = end
    return "".join([*parts, text[at:]])


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs)).select("doc_id", "secret_spans")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("secret_spans", lambda s: s.kind != "network")
    of_kind = lambda kind: F.filter("secret_spans", lambda s: s.kind == kind)
    counts = {f"n_{k}": F.size(of_kind(k)).cast("long") for k in KINDS[:3]}
    return found.select("doc_id", *[c.alias(n) for n, c in counts.items()], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("secret_spans")).alias("spans"))
