"""Language identification by interpolated Kneser-Ney character models.

One model per language over the characters of lower-cased words (letters and
the marks on them, padded at both ends).  Spark counts words per language,
then character n-grams of the distinct words; continuation counts, discounts
and back-off weights follow from the distinct n-grams of the highest order.
The models live in sorted 64-bit hash arrays, one per order, with one column
of log-probabilities per language; a lookup is a binary search for the whole
batch.  The language with the lowest cross-entropy per symbol wins.  The
cross-entropies of all training documents calibrate a rejection limit per
language.

Scale: the only shuffles are pre-aggregated word and n-gram counts; scoring is
one pass without a shuffle.  Every n-gram counts.  A model of up to
``MODEL_CELLS`` n-grams times languages is fitted on the driver and broadcast
as one (about 100 MB).  A larger one is fitted by Spark aggregates over the
n-gram table, and its entries are broadcast in blocks of key ranges of at most
that many cells: a log-probability is a sum over entries, so a task adds up one
block after the other for the distinct words of a batch.  Size only changes the
number of blocks.

Defined results: a null text and one without a letter are ``und`` with score
0 and are rejected; without any learnable row every document is ``und``; ties
go to the language first in alphabetical order; rows are neither dropped nor
merged; rows whose id is null teach nothing and are not held out; a language
whose teaching rows are all taken for others has no limit; other columns are
ignored (``keep_identified``: passed through).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.components import written

ORDER = 5
#: N-grams times languages that are held at once; a larger model comes in blocks.
MODEL_CELLS = 1 << 23
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_START, _END = "\x02", "\x03"
#: Symbols from which a text's cross-entropy no longer gets steadier (its subject differs, not its luck).
_SETTLED = 400
_CACHE = 200_000
#: Texts of an Arrow batch that are Python strings at a time.
_ROWS = 256
_C = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _count_words(batches):
    for batch in batches:
        count: dict[tuple[str, str], int] = {}
        for i in range(0, batch.num_rows, _ROWS):
            part = batch.slice(i, _ROWS)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for w in words_of(text):
                    count[lang, w] = count.get((lang, w), 0) + 1
            if len(count) > _CACHE:
                yield _triples(count)
                count = {}
        yield _triples(count)


def _triples(count: dict[tuple[str, str], int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in count], pa.string()), pa.array([k[1] for k in count], pa.string()),
                                       pa.array(list(count.values()), pa.int64())], ["lang", "w", "c"])


def _codes(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of ``order`` symbols of the padded words, as code points
    [windows, order], the word of each window, and windows per word."""
    text = _START * (order - 1) + (_END + _START * (order - 1)).join(words) + _END
    flat = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    n = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
    at = np.arange(int(n.sum())) + np.repeat(np.arange(len(words)) * (order - 1), n)
    return np.lib.stride_tricks.sliding_window_view(flat, order)[at], np.repeat(np.arange(len(words)), n), n


def _hash(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of symbols (the number of symbols counts)."""
    h = np.full(len(codes), codes.shape[1], dtype=np.uint64)
    for j in range(codes.shape[1]):
        h = (h ^ codes[:, j]) * _C
        h ^= h >> np.uint64(32)
    return h


def _count_grams(order: int):
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            words, counts = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for lang in sorted(set(langs)):
                pick = np.flatnonzero(langs == lang)
                codes, of, _ = _codes([words[i] for i in pick], order)
                key = _hash(codes)
                _, first, back = np.unique(key, return_index=True, return_inverse=True)
                c = np.bincount(back, weights=counts[pick][of].astype(float), minlength=len(first))
                grams = np.ascontiguousarray(codes[first]).tobytes().decode("utf-32-le")
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(first), pa.string()),
                    pa.array([grams[i:i + order] for i in range(0, len(grams), order)], pa.string()),
                    pa.array(c.astype(np.int64))], ["lang", "g", "c"])
    return run


@dataclass
class LanguageModels:
    """keys[k], logp[k]: sorted hashes of k-symbol grams and log-probability
    of their last symbol, a column per language.  ctx[k], weight[k]: the same
    for the back-off log-weight after k - 1 symbols."""

    langs: list[str]
    order: int
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    logp: dict[int, np.ndarray] = field(default_factory=dict)
    ctx: dict[int, np.ndarray] = field(default_factory=dict)
    weight: dict[int, np.ndarray] = field(default_factory=dict)
    floor: np.ndarray | None = None

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Log-probability of the last symbol of every row, per language."""
        out = np.zeros((len(codes), len(self.langs)))
        todo = np.arange(len(codes))
        for k in range(self.order, 0, -1):
            at, hit = _find(self.keys[k], _hash(codes[todo, self.order - k:]))
            out[todo[hit]] += self.logp[k][at[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            at, seen = _find(self.ctx[k], _hash(codes[todo, self.order - k:self.order - 1]))
            out[todo[seen]] += self.weight[k][at[seen]]
        out[todo] += self.floor
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def fit_models(langs: list[str], lang: np.ndarray, codes: np.ndarray, count: np.ndarray) -> LanguageModels:
    """Interpolated Kneser-Ney from the highest-order grams: language index,
    symbols [n, order] and count of each."""
    order, n_langs = codes.shape[1], len(langs)
    model = LanguageModels(langs, order)
    alphabet = len(np.unique(codes[:, -1])) + 1
    levels = {}
    c = count.astype(float)
    for k in range(order, 0, -1):  # counts: the highest order as is, below it distinct predecessors
        levels[k] = (lang, codes, c)
        if k > 1:
            shorter = codes[:, 1:]
            key = _hash(shorter) ^ ((lang.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
            _, first, back = np.unique(key, return_index=True, return_inverse=True)
            c = np.bincount(back, minlength=len(first)).astype(float)
            lang, codes = lang[first], shorter[first]
    for k in range(1, order + 1):
        lang, codes, c = levels[k]
        full, before = _hash(codes), _hash(codes[:, :-1])
        keys, first, at = np.unique(full, return_index=True, return_inverse=True)
        ctx, cat = np.unique(before, return_inverse=True)
        cell = cat * n_langs + lang
        total = np.bincount(cell, weights=c, minlength=len(ctx) * n_langs).reshape(-1, n_langs)
        kinds = np.bincount(cell, minlength=len(ctx) * n_langs).reshape(-1, n_langs)
        n1 = np.bincount(lang[c == 1], minlength=n_langs).astype(float)
        n2 = np.bincount(lang[c == 2], minlength=n_langs).astype(float)
        d = np.clip((n1 + 0.5) / (n1 + 2 * n2 + 1), 0.1, 0.9)
        weight = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        if k == 1:
            lower = np.full((len(keys), n_langs), 1.0 / alphabet)
        else:
            down, _ = _find(model.keys[k - 1], _hash(codes[first][:, 1:]))
            lower = np.exp(model.logp[k - 1][down])
        context_of = cat[first]
        p = weight[context_of] * lower
        own = np.zeros((len(keys), n_langs))
        own[at, lang] = np.maximum(c - d[lang], 0) / total[cat, lang]
        model.keys[k], model.logp[k] = keys, np.log(p + own).astype(np.float32)
        model.ctx[k], model.weight[k] = ctx, np.log(weight).astype(np.float32)
    model.floor = np.full(n_langs, -np.log(alphabet))
    return model


def _key(codes: np.ndarray, context: bool) -> np.ndarray:
    """Hashes that keep lengths, and contexts from n-grams, apart."""
    kind = (2 * codes.shape[1] + 1 + context) * 0xA0761D6478BD642F
    return _hash(codes) ^ np.uint64(kind & ((1 << 64) - 1))


@dataclass
class BlockModels:
    """The same models as a sum: the log-probability of a symbol is ``floor``
    plus, of every order, the back-off log-weight of its context and the gain
    of its n-gram over backing off, each 0 where a language has none.  A block
    holds the sorted keys of a range and a column of values per language."""

    langs: list[str]
    order: int
    floor: float
    blocks: list  # broadcasts of (keys, values)

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Log-probability of the last symbol of every row, per language."""
        _, first, back = np.unique(_hash(codes), return_index=True, return_inverse=True)
        part = codes[first]
        wanted = [_key(part[:, self.order - k:], False) for k in range(1, self.order + 1)]
        wanted += [_key(part[:, self.order - k:self.order - 1], True) for k in range(1, self.order + 1)]
        out = np.full((len(part), len(self.langs)), self.floor)
        for block in self.blocks:
            keys, values = _unkept(block)
            for w in wanted:
                at, hit = _find(keys, w)
                out[hit] += values[at[hit]]
        return out[back]


def _unkept(block):
    """Value of a broadcast, not kept by it: one block at a time is in memory."""
    path = getattr(block, "_path", None)
    return block.load_from_path(path) if path else block.value


def _entry_keys(langs: list[str]):
    """(lang, context, s, v) -> key, language index, v."""
    place = {x: i for i, x in enumerate(langs)}

    def run(batches):
        for batch in batches:
            text = batch.column(2).to_pylist()
            kind = np.array([2 * len(x) for x in text], dtype=np.int64) + batch.column(1).to_numpy(zero_copy_only=False)
            key = np.zeros(len(text), np.uint64)
            for k in np.unique(kind):
                pick = np.flatnonzero(kind == k)
                flat = np.array([ord(x) for i in pick for x in text[i]], dtype=np.uint32)
                key[pick] = _key(flat.reshape(len(pick), k // 2), bool(k % 2))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(
                [place[x] for x in batch.column(0).to_pylist()], pa.int32()), batch.column(3)], ["key", "lang", "v"])
    return run


def fit_blocks(grams: DataFrame, langs: list[str], order: int, cells: int = MODEL_CELLS) -> BlockModels:
    """The law of ``fit_models`` over a table (lang, g, c) of any size."""
    spark = grams.sparkSession
    levels = {order: grams}
    for k in range(order - 1, 0, -1):  # distinct predecessors
        levels[k] = written(spark, levels[k + 1].groupBy("lang", F.expr("substring(g, 2)").alias("g"))
                            .agg(F.count("*").alias("c")), "char-levels")
    alphabet = levels[1].select("g").distinct().count() + 1
    entries, lower = None, None
    for k in range(1, order + 1):
        level = levels[k].withColumn("h", F.substring("g", 1, k - 1))
        discount = level.groupBy("lang").agg(F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).select(
            "lang", F.expr("greatest(0.1D, least(0.9D, (n1 + 0.5D) / (n1 + 2 * n2 + 1)))").alias("d"))
        context = written(spark, level.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
                          .join(F.broadcast(discount), "lang").withColumn("weight", F.expr("d * kinds / total")), "char-contexts")
        rows = level.join(context, ["lang", "h"])
        rows = rows.withColumn("lower", F.lit(1.0 / alphabet)) if lower is None else rows.withColumn(
            "rest", F.expr("substring(g, 2)")).join(lower, ["lang", "rest"])
        fitted = written(spark, rows.select("lang", "g", F.expr("(c - d) / total").alias("own"), F.expr("weight * lower").alias("less")),
                         "char-fitted")
        lower = fitted.select("lang", F.col("g").alias("rest"), F.expr("own + less").alias("lower"))
        part = fitted.select("lang", F.lit(False).alias("context"), F.col("g").alias("s"), F.expr("log1p(own / less)").alias("v")).union(
            context.select("lang", F.lit(True), "h", F.log("weight")))
        entries = part if entries is None else entries.union(part)
    entries = written(spark, entries.withColumn("v", F.col("v").cast("float"))
                      .mapInArrow(_entry_keys(langs), "key long, lang int, v float"), "char-entries")
    count = -(-entries.select("key").distinct().count() * len(langs) // cells)
    ranged = written(spark, entries.repartitionByRange(count, "key"), "char-entries")
    edges = [-(1 << 63) + (i << 64) // count for i in range(count + 1)]  # keys are hashes: ranges of equal width are alike
    blocks = [spark.sparkContext.broadcast(_block(
        ranged.where((F.col("key") >= F.lit(a)) & (F.col("key") <= F.lit(b - 1))).toArrow(), len(langs))) for a, b in zip(edges, edges[1:])]
    return BlockModels(langs, order, -float(np.log(alphabet)), blocks)


def _block(table: pa.Table, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(table.column("key").to_numpy().view(np.uint64), return_inverse=True)
    values = np.zeros((len(keys), n_langs), np.float32)
    values[at, table.column("lang").to_numpy()] = table.column("v").to_numpy()
    return keys, values


def train(docs: DataFrame, order: int = ORDER, cells: int = MODEL_CELLS) -> LanguageModels | BlockModels | None:
    """Models from the rows (lang, text) of ``docs``; None without a word."""
    spark = docs.sparkSession
    words = (docs.where("lang is not null and text is not null").select("lang", "text")
             .mapInArrow(_count_words, "lang string, w string, c long")
             .groupBy("lang", "w").agg(F.sum("c").alias("c")))
    grams = written(spark, words.mapInArrow(_count_grams(order), "lang string, g string, c long")
                    .groupBy("lang", "g").agg(F.sum("c").alias("c")), "char-grams")
    sizes = {r.lang: r["count"] for r in grams.groupBy("lang").count().collect()}  # a row per language
    langs = sorted(sizes)
    if not langs:
        return None
    if sum(sizes.values()) * len(langs) > cells:
        return fit_blocks(grams, langs, order, cells)
    table = grams.toArrow()
    names = table.column("lang").combine_chunks().dictionary_encode()
    if isinstance(names, pa.ChunkedArray):
        names = names.combine_chunks()
    place = np.array([langs.index(x) for x in names.dictionary.to_pylist()])
    codes = np.frombuffer("".join(table.column("g").to_pylist()).encode("utf-32-le"), dtype=np.uint32).reshape(-1, order)
    return fit_models(langs, place[names.indices.to_numpy()], codes, table.column("c").to_numpy())


class Scorer:
    """Sums of log-probabilities of texts; remembers the words it has met."""

    def __init__(self, model: LanguageModels | BlockModels):
        self.model, self.at = model, {}
        self.table = np.zeros((0, len(model.langs) + 1))

    def _learn(self, words: list[str]) -> None:
        rows, most = [], _CACHE if isinstance(self.model, BlockModels) else 20_000
        for i in range(0, len(words), most):
            codes, of, n = _codes(words[i:i + most], self.model.order)
            logp = self.model.score(codes)
            edge = np.concatenate([[0], np.cumsum(n)[:-1]])
            rows.append(np.column_stack([np.add.reduceat(logp, edge, axis=0), n]))
        base = len(self.table)
        self.table = np.concatenate([self.table, *rows])
        self.at.update((w, base + i) for i, w in enumerate(words))

    def prepare(self, texts: pa.Array, a: int) -> int:
        """Learns the words of the rows from ``a`` on, as many as the memory
        takes, and returns the row after: blocks are read once for all of them."""
        if not isinstance(self.model, BlockModels):
            return len(texts)
        unknown, b = set(), a
        while b < len(texts) and len(unknown) < _CACHE // 2:
            for text in texts.slice(b, _ROWS).to_pylist():
                unknown.update(w for w in words_of(text) if w not in self.at)
            b = min(b + _ROWS, len(texts))
        if self.at and len(self.at) + len(unknown) > _CACHE:
            self.at, self.table = {}, self.table[:0]
            return self.prepare(texts, a)
        if unknown:
            self._learn(list(unknown))
        return b

    def sums(self, texts: list[str | None]) -> np.ndarray:
        """Per text: log-probability per language, and the number of symbols."""
        out = np.zeros((len(texts), len(self.model.langs) + 1))
        a = 0
        while a < len(texts):
            b, size, words = a, 0, []
            while b < len(texts) and size < 300_000:
                words.append(words_of(texts[b]))
                size += len(words[-1])
                b += 1
            flat = list(chain.from_iterable(words))
            unknown = set(flat).difference(self.at)
            if len(self.at) + len(unknown) > _CACHE:  # forget, then learn all words of this run
                self.at, self.table, unknown = {}, self.table[:0], set(flat)
            if unknown:
                self._learn(list(unknown))
            n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            some = np.flatnonzero(n)
            if len(some):
                edge = (np.cumsum(n) - n)[some]
                index = np.fromiter(map(self.at.__getitem__, flat), dtype=np.int64, count=len(flat))
                out[a + some] = np.add.reduceat(self.table[index], edge, axis=0)
            a = b
        return out


def _judge(batch: pa.RecordBatch, scorer: Scorer) -> dict[str, np.ndarray]:
    langs = scorer.model.langs
    text = batch.column("text")
    parts, a = [np.zeros((0, len(langs) + 1))], 0
    while a < len(text):
        b = scorer.prepare(text, a)
        parts += [scorer.sums(text.slice(i, min(_ROWS, b - i)).to_pylist()) for i in range(a, b, _ROWS)]
        a = b
    got = np.concatenate(parts)
    n = got[:, -1]
    entropy = -got[:, :-1] / np.maximum(n, 1)[:, None]
    best = entropy.argmin(axis=1)
    least = entropy[np.arange(len(n)), best]
    chance = 1 / np.exp((least[:, None] - entropy) * np.minimum(n, 60)[:, None]).sum(axis=1)
    known = n > 0
    return {"lang_pred": np.where(known, np.array(langs, dtype=object)[best], "und"), "score": np.where(known, chance, 0.0),
            "cross_entropy": np.where(known, least, np.nan), "symbols": n.astype(np.int64)}


def _scorer(spark: SparkSession, model: LanguageModels | BlockModels):
    """Makes, in a task, a scorer of ``model``."""
    if isinstance(model, BlockModels):
        return lambda: Scorer(model)
    held = spark.sparkContext.broadcast(model)
    return lambda: Scorer(held.value)


def _score(make):
    def run(batches):
        scorer = make()
        for batch in batches:
            out = {f: batch.column(f) for f in batch.schema.names if f != "text"}
            out |= {k: pa.array(v, from_pandas=k == "cross_entropy") for k, v in _judge(batch, scorer).items()}
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
    return run


def _keep(make, limits: dict[str, tuple[float, float]]):
    def run(batches):
        scorer = make()
        for batch in batches:
            got = _judge(batch, scorer)
            mean, far = (np.array([limits.get(x, (0, np.inf))[i] for x in got["lang_pred"]], dtype=float) for i in (0, 1))
            z = (got["cross_entropy"] - mean) * np.sqrt(np.minimum(got["symbols"], _SETTLED))
            yield batch.filter(pa.array((got["symbols"] > 0) & (z <= far)))
    return run


_SCORES = "lang_pred string, score double, cross_entropy double, symbols long"
#: Deviation from a language's mean, scaled by length so that short texts may deviate more.
_DEVIATION = f"(cross_entropy - mean) * sqrt(least(symbols, {_SETTLED}))"


def _taught(learn: str) -> str:
    return f"doc_id is not null and lang is not null and text is not null and ({learn})"


def limits_of(scores: DataFrame, slack: float = 2.0) -> DataFrame:
    """Rejection limits (lang, mean, far), a row per language, from the scores
    (lang, lang_pred, cross_entropy, symbols) of all teaching rows: mean
    cross-entropy and ``slack`` times the deviation that 99.9 % of the rows
    don't exceed (its rank is right to 1/100,000 of the rows)."""
    own = scores.where("lang = lang_pred and symbols > 0")
    mean = own.groupBy("lang").agg(F.avg("cross_entropy").alias("mean"))
    far = (own.join(F.broadcast(mean), "lang").groupBy("lang", "mean")
           .agg(F.percentile_approx(F.expr(_DEVIATION), 0.999, 100_000).alias("z")))
    return far.select("lang", "mean", (slack * F.greatest("z", F.lit(1.0))).alias("far"))


def identify(docs: DataFrame, learn: str, order: int = ORDER, cells: int = MODEL_CELLS) -> DataFrame:
    """``docs`` (doc_id, text, lang, ...) -> doc_id, held_out, lang_pred,
    score, cross_entropy, symbols, accepted; ``learn`` is an SQL condition:
    rows that teach.  accepted: it has a letter, and its cross-entropy is
    within the language's limit."""
    spark = docs.sparkSession
    model = train(docs.where(_taught(learn)), order, cells)
    docs = docs.select("doc_id", "text", "lang", F.coalesce(F.expr(_taught(learn)), F.lit(False)).alias("taught"),
                       (~F.coalesce(F.expr(learn), F.lit(True))).alias("held_out"))
    if model is None:
        return docs.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("cross_entropy"), F.lit(0).cast("long").alias("symbols"),
                           F.lit(False).alias("accepted"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scores = written(spark, docs.mapInArrow(
        _score(_scorer(spark, model)), f"doc_id {kind}, lang string, taught boolean, held_out boolean, {_SCORES}"), "language-scores")
    limits = limits_of(scores.where("taught")).withColumnRenamed("lang", "of")
    return scores.join(F.broadcast(limits), F.col("lang_pred") == F.col("of"), "left").select(
        "doc_id", "held_out", "lang_pred", "score", "cross_entropy", "symbols",
        F.expr(f"symbols > 0 and coalesce({_DEVIATION} <= far, true)").alias("accepted"))


def keep_identified(docs: DataFrame, learn: str = "true", order: int = ORDER, cells: int = MODEL_CELLS) -> DataFrame:
    """The accepted rows of ``docs``, all columns as they are; without any
    teaching row nothing can be judged and everything stays."""
    spark = docs.sparkSession
    taught = docs.where(_taught(learn)).select("lang", "text")
    model = train(taught, order, cells)
    if model is None:
        return docs
    make = _scorer(spark, model)
    scores = written(spark, taught.mapInArrow(_score(make), f"lang string, {_SCORES}"), "language-scores")
    limits = {r.lang: (r.mean, r.far) for r in limits_of(scores).collect()}  # a row per language
    return docs.mapInArrow(_keep(make, limits), docs.schema)
