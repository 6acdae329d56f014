"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model, with thresholds by language.

The model predicts the characters of whole texts, spaces and line ends among
them, so n-grams run over word boundaries; there is one model per language.
A text stands between ``order - 1`` start marks and one end mark. Counts,
context totals and lower-order probabilities are joined by (language, n-gram),
so that training is a chain of sharded joins and no count is gathered anywhere.

Trusted texts are dealt to ``FOLDS`` by hash of the text. All folds but the
first train the model; the first sets the thresholds, as texts that the model
has seen score better than new ones. A language's threshold is a quantile of
those documents' perplexities, counted exactly in steps of 0.001 of the
logarithm; a language that has none takes it from its training documents.

Scoring: the distinct windows of ``order`` characters of all documents are
counted, and each is scored once, by joins with the sharded model. The scores of
the most frequent windows, ``head`` at most (16 bytes each), are broadcast; the
other windows are counted by document and joined with their scores. Perplexity
is per character. Windows are told apart by 64-bit hashes of language and text.

Defined results: a null, empty or blank text has no perplexity and isn't kept; a
language without training text has no model: its documents have no perplexity
and are kept if they have words; null is a language of its own; repeated rows
get the same result each; texts of any length are scored whole; a doc_id that
occurs twice is trusted in all its rows; other columns aren't read, so their names
can't clash; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acreage.llm.scratch import written
from acreage.llm.words import Words, mix64, multipliers, slices, text_bytes

ORDER = 5
QUANTILE = 0.97
FOLDS = 5
HEAD = 1 << 20
#: Ids of trusted documents are broadcast up to this many bytes, and joined by shuffle beyond.
BROADCAST_BYTES = 64 << 20
_SLICE = 2 << 20
_MERGED = 1 << 20
_CHUNK = 1 << 16
_BEGIN, _END = "\x02", "\x03"


class _Windows:
    """Runs of ``order`` code points of padded texts; ``valid`` marks those that lie within one text."""

    def __init__(self, texts: pa.Array, order: int) -> None:
        padded = pc.binary_join_element_wise(_BEGIN * (order - 1), texts, _END, "")
        raw, _ = text_bytes(padded)
        self.order = order
        self.points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        self.begin = np.concatenate([[0], np.cumsum(pc.utf8_length(padded).to_numpy())]).astype(np.int64)
        self.size = max(len(self.points) - order + 1, 0)
        self.valid = np.ones(self.size, bool)
        across = (self.begin[1:, None] - np.arange(1, order)).ravel()
        self.valid[across[across < self.size]] = False

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct windows as rows of code points, and how often each occurs."""
        seen = np.zeros(0x110000, bool)
        seen[self.points] = True
        alphabet = np.flatnonzero(seen)
        number = np.zeros(0x110000, np.int64)
        number[alphabet] = np.arange(len(alphabet))
        ids = number[self.points]
        key, most, tables = ids[: self.size].copy(), len(alphabet), {}
        for k in range(1, self.order):
            if most * len(alphabet) >= 1 << 62:  # a very large alphabet: number the runs so far
                tables[k], key = np.unique(key, return_inverse=True)
                most = len(tables[k])
            key *= len(alphabet)
            key += ids[k : k + self.size]
            most *= len(alphabet)
        key = np.sort(key[self.valid])
        first = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
        key, times = key[first], np.diff(np.append(first, len(key)))
        grams = np.empty((len(key), self.order), np.uint32)
        for k in range(self.order - 1, 0, -1):
            key, grams[:, k] = key // len(alphabet), alphabet[key % len(alphabet)]
            key = tables[k][key] if k in tables else key
        grams[:, 0] = alphabet[key]
        return grams, times

    def hashes(self, salt: np.uint64) -> np.ndarray:
        out = np.zeros(self.size, np.uint64)
        for a in range(0, self.size, _CHUNK):
            b = min(a + _CHUNK, self.size)
            points = self.points[a : b + self.order - 1].astype(np.uint64)
            out[a:b] = _hashed([points[k : k + b - a] for k in range(self.order)], salt)
        return out


def _hashed(columns: list[np.ndarray], salt: np.uint64) -> np.ndarray:
    total = np.full(len(columns[0]), salt)
    for factor, column in zip(multipliers(len(columns), 20), columns, strict=True):
        total += column * factor
    return mix64(total)


def _salt(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode(), np.uint8).astype(np.uint64)
    return mix64(np.array([int((raw * multipliers(len(raw), 21)).sum(dtype=np.uint64)) & (2**64 - 1)], np.uint64))[0]


def _language() -> Column:
    return F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "lang"))


def _by_language(piece: pa.RecordBatch, flag: str | None = None) -> Iterator[tuple[str, bool, np.ndarray]]:
    """(language, flag, row numbers) of a batch's rows."""
    named = piece.column("_lang").dictionary_encode()
    code = named.indices.to_numpy().astype(np.int64) * 2
    if flag:
        code += piece.column(flag).to_numpy(zero_copy_only=False)
    names = named.dictionary.to_pylist()
    for k in np.unique(code).tolist():
        yield names[k // 2], bool(k % 2), np.flatnonzero(code == k)


def _gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """(lang, gram, h, raw, trusted): how often windows occur in all texts and in those with ``_train``, counted in each task first."""
    text = [("lang", pa.string()), ("gram", pa.string()), ("h", pa.int64()), ("raw", pa.int64()), ("trusted", pa.int64())]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[tuple[np.ndarray, ...]]] = {}

        def merge(lang: str) -> int:
            grams, h, raw, trusted = (np.concatenate(x) for x in zip(*waiting[lang], strict=True))
            order_ = np.argsort(h)
            first = np.flatnonzero(np.concatenate([np.ones(min(len(h), 1), bool), h[order_[1:]] != h[order_[:-1]]]))
            one = order_[first]
            waiting[lang] = [(grams[one], h[one], *(np.add.reduceat(x[order_], first) if len(h) else x for x in (raw, trusted)))]
            return len(one)

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, [(grams, h, raw, trusted)] in waiting.items():
                for a in range(0, len(h), _CHUNK):
                    own = slice(a, a + _CHUNK)
                    whole = grams[own].astype("<u4").tobytes().decode("utf-32-le")
                    said = [whole[k : k + order] for k in range(0, len(whole), order)]
                    columns = [[lang] * len(said), said, h[own].view(np.int64), raw[own], trusted[own]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, text, strict=True)], names=[n for n, _ in text])
            waiting.clear()

        held = 0
        for piece in slices(batches, "text", _SLICE):
            for lang, trusted, rows in _by_language(piece, "_train"):
                grams, times = _Windows(piece.column("text").take(pa.array(rows)), order).counted()
                h = _hashed([grams[:, k].astype(np.uint64) for k in range(order)], _salt(lang))
                waiting.setdefault(lang, []).append((grams, h, times, times if trusted else np.zeros_like(times)))
                held += len(h)
            if held > _MERGED:
                held = sum(merge(lang) for lang in waiting)
                if held > _MERGED // 2:
                    yield from emptied()
                    held = 0
        for lang in waiting:
            merge(lang)
        yield from emptied()

    worded = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    grams = worded.select("_lang", "_train", "text").mapInArrow(go, "lang string, gram string, h long, raw long, trusted long")
    return grams.groupBy("lang", "gram", "h").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def train(grams: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """Probabilities (lang, gram, logp) of n-grams of all orders, and back-off weights (lang, ctx, logbow) of contexts, from (lang, gram, raw) of the highest order."""
    levels = [written(grams.select("lang", "gram", "raw", F.col("raw").alias("c")), "kn-counts")]
    for k in range(order - 1, 0, -1):
        # below the highest order an n-gram counts the characters that come before it; at a text's start there is only one, so its own count stands
        lower = levels[0].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.sum("raw").alias("raw"), F.count("*").alias("types"))
        levels.insert(0, written(lower.withColumn("c", F.when(F.col("gram").startswith(_BEGIN), F.col("raw")).otherwise(F.col("types"))).drop("types"), "kn-counts"))
    lower, probabilities, weights = None, [], []
    for k, level in enumerate(levels, start=1):
        times = level.groupBy("lang").agg(*(F.count_if(F.col("c") == j).alias(f"t{j}") for j in (1, 2, 3, 4)), F.count("*").alias("types"))
        y = F.coalesce(F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2")), F.lit(0.5))

        def discount(j: int, y: Column = y) -> Column:
            d = F.lit(j) - (j + 1) * y * F.coalesce(F.try_divide(F.col(f"t{j + 1}"), F.col(f"t{j}")), F.lit(0.0))
            return F.greatest(F.least(d, F.lit(j - 0.05)), F.lit(0.05)).alias(f"d{j}")

        discounts = F.broadcast(times.select(F.col("lang").alias("l"), discount(1), discount(2), discount(3), F.col("types")))  # a row per language
        counted = level.join(discounts, level["lang"] == discounts["l"]).drop("l")
        taken = F.when(F.col("c") >= 3, F.col("d3")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d1"))
        counted = counted.select("lang", "gram", F.substring("gram", 1, k - 1).alias("ctx"), "c", taken.alias("d"), "types")
        contexts = counted.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("mass"))
        joined = counted.join(contexts, ["lang", "ctx"])
        if lower is None:
            under = joined.withColumn("under", 1 / (F.col("types") + 1))
        else:
            below = lower.select("lang", F.col("gram").alias("_tail"), F.col("p").alias("under"))
            under = joined.withColumn("_tail", F.substring("gram", 2, k - 1)).join(below, ["lang", "_tail"])
        p = (F.col("c") - F.col("d") + F.col("mass") * F.col("under")) / F.col("total")
        lower = written(under.select("lang", "gram", p.alias("p")), "kn-probabilities")
        probabilities.append(lower.select("lang", "gram", F.log("p").alias("logp")))
        weight = F.log(F.col("mass") / F.col("total"))
        if k == 1:
            unseen = contexts.join(discounts.select(F.col("l").alias("lang"), "types"), "lang")
            weights.append(unseen.select("lang", "ctx", (weight - F.log(F.col("types") + 1)).alias("logbow")))  # includes the uniform share of an unseen character
        else:
            weights.append(contexts.select("lang", "ctx", weight.alias("logbow")))
    all_p, all_w = probabilities[0], weights[0]
    for p, w in zip(probabilities[1:], weights[1:], strict=True):
        all_p, all_w = all_p.unionByName(p), all_w.unionByName(w)
    return all_p, written(all_w, "kn-weights")


class _Table:
    """Sorted 64-bit keys with values, looked up many at once from the first key of each key's bucket."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = len(keys).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        sizes = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.start = (np.cumsum(sizes) - sizes).astype(np.int32)
        self.keys, self.values = np.append(keys, np.uint64(2**64 - 1)), np.append(values, np.nan)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Each key's value; NaN for a key that isn't there."""
        at = self.start[(h >> self.shift).astype(np.int64)]
        rest = np.flatnonzero(self.keys[at] < h)
        while len(rest):
            at[rest] += 1
            rest = rest[self.keys[at[rest]] < h[rest]]
        return np.where(self.keys[at] == h, self.values[at], np.nan)


def _window_scores(windows: DataFrame, probabilities: DataFrame, weights: DataFrame, order: int) -> DataFrame:
    """(lang, h, raw, score) of distinct windows in languages with a model, by joins with the sharded tables."""
    trained = weights.where("ctx = ''").select("lang")  # a row per language
    places, backed, scored = windows.join(F.broadcast(trained), "lang", "left_semi").withColumn("_backed", F.lit(0.0)), F.col("_backed"), None
    for k in range(order, 0, -1):
        p = probabilities.where(F.length("gram") == k).select("lang", F.col("gram").alias("_gram"), "logp")
        places = written(places.withColumn("_gram", F.substring("gram", order - k + 1, k)).join(p, ["lang", "_gram"], "left").drop("_gram"), "kn-places")
        found = places.where("logp is not null").select("lang", "h", "raw", (backed + F.col("logp")).alias("score"))
        scored = found if scored is None else scored.unionByName(found)
        w = weights.where(F.length("ctx") == k - 1).select("lang", F.col("ctx").alias("_ctx"), "logbow")
        places = places.where("logp is null").drop("logp").withColumn("_ctx", F.substring("gram", order - k + 1, k - 1)).join(w, ["lang", "_ctx"], "left")
        places = places.select("lang", "gram", "h", "raw", (backed + F.coalesce("logbow", F.lit(0.0))).alias("_backed"))
    return written(scored.unionByName(places.select("lang", "h", "raw", F.col("_backed").alias("score"))), "kn-window-scores")


def _scored(docs: DataFrame, windows: DataFrame, weights: DataFrame, order: int, head: int) -> DataFrame:
    """(doc_id, lang, _held, _train, n_words, chars, total) of each row: the sum of its windows' scores."""
    level = F.floor(F.log2("raw") * 16)
    upto, least = 0, None
    for r in windows.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():  # at most 1,024 rows
        upto += r["n"]
        if upto > head:
            break
        least = r["level"]
    in_head = F.lit(False) if least is None else level >= least
    found = windows.where(in_head).select("lang", "h", "score").toArrow()  # ``head`` rows at most
    langs, keys, scores = found.column("lang").combine_chunks(), found.column("h").to_numpy().view(np.uint64), found.column("score").to_numpy()
    tables = {}
    for lang in [r[0] for r in weights.where("ctx = ''").select("lang").collect()]:  # a row per language
        own = np.flatnonzero(pc.equal(langs, lang).to_numpy(zero_copy_only=False)) if len(keys) else np.zeros(0, np.int64)
        own = own[np.argsort(keys[own])]
        tables[lang] = keys[own], scores[own]
    sent = docs.sparkSession.sparkContext.broadcast(tables)
    names = ["_row", "doc_id", "lang", "_held", "_train", "n_words", "chars", "total", "late"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = {lang: _Table(*t) for lang, t in sent.value.items()}, TaskContext.get().partitionId() << 40
        for piece in slices(batches, "text", _SLICE):
            n_words = Words.of(piece.column("text")).counts
            chars, total = np.zeros(piece.num_rows, np.int64), np.zeros(piece.num_rows)
            late: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
            for lang, _, rows in _by_language(piece):
                rows = rows[n_words[rows] > 0]
                if lang not in known or not len(rows):
                    continue
                x = _Windows(piece.column("text").take(pa.array(rows)), order)
                h = x.hashes(_salt(lang))
                score = known[lang].find(h)
                missing = np.flatnonzero(np.isnan(score) & x.valid)
                score[~x.valid] = 0
                score[missing] = 0
                chars[rows] = np.diff(x.begin) - order + 1
                total[rows] = np.add.reduceat(score, x.begin[:-1])
                if len(missing):
                    owner = np.searchsorted(x.begin, missing, "right") - 1
                    sorted_ = np.lexsort((h[missing], owner))
                    a, b = owner[sorted_], h[missing][sorted_]
                    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
                    late.append((rows[a[first]], b[first], np.diff(np.append(first, len(a)))))
            at, rest, times = (np.concatenate(c) for c in zip(*late, strict=True))
            sorted_ = np.argsort(at, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=piece.num_rows))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(rest[sorted_].view(np.int64)), pa.array(times[sorted_])], ["h", "n"]))
            columns = [pa.array(row + np.arange(piece.num_rows)), *(piece.column(c) for c in ("doc_id", "lang", "_held", "_train")), pa.array(n_words.astype(np.int64)), pa.array(chars), pa.array(total), lists]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            row += piece.num_rows

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"_row long, doc_id {kind}, lang string, _held boolean, _train boolean, n_words long, chars long, total double, late array<struct<h: long, n: long>>"
    parts = written(docs.select("doc_id", "lang", "_lang", "_held", "_train", "text").mapInArrow(go, schema), "kn-parts")  # a row's number holds from here on
    late = parts.select("_row", F.inline("late")).join(windows.where(~in_head).select("h", "score"), "h")
    late = written(late.groupBy("_row").agg(F.sum(F.col("n") * F.col("score")).alias("_late")), "kn-late")
    return parts.join(late, "_row", "left").select("doc_id", "lang", "_held", "_train", "n_words", "chars", (F.col("total") + F.coalesce("_late", F.lit(0.0))).alias("total"))


def _flagged(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """(doc_id, lang, _lang, _held, _train, text): the trusted rows are held out or train."""
    ids = trusted_ids.select("doc_id").where("doc_id is not null").distinct().withColumn("_trusted", F.lit(True))
    volume = ids.agg(F.coalesce(F.sum(F.octet_length(F.col("doc_id").cast("string")) + 16), F.lit(0))).first()[0]
    docs = docs.select("doc_id", "lang", "text").join(F.broadcast(ids) if volume <= BROADCAST_BYTES else ids, "doc_id", "left")
    trusted, first = F.coalesce("_trusted", F.lit(False)), F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == 0
    return docs.select("doc_id", "lang", _language().alias("_lang"), (trusted & first).alias("_held"), (trusted & ~first).alias("_train"), "text")


def classify(docs: DataFrame, trusted_ids: DataFrame, order: int = ORDER, quantile: float = QUANTILE, head: int = HEAD) -> DataFrame:
    """(doc_id, lang, n_words, perplexity, threshold, kept) of each row; ``trusted_ids`` has the doc_id of trusted documents."""
    flagged = _flagged(docs, trusted_ids)
    grams = written(_gram_counts(flagged, order), "kn-grams")
    probabilities, weights = train(grams.where("trusted > 0").select("lang", "gram", F.col("trusted").alias("raw")), order)
    windows = _window_scores(grams.select("lang", "gram", "h", "raw"), probabilities, weights, order)
    scored = written(_scored(flagged, windows, weights, order, head).withColumn("_log", F.when(F.col("chars") > 0, -F.col("total") / F.col("chars"))), "kn-scores")
    steps = scored.where("(_held or _train) and _log is not null").groupBy("lang", "_held", F.ceil(F.col("_log") * 1000).alias("_step")).agg(F.count("*").alias("n"))
    group = Window.partitionBy("lang", "_held")  # a row per step: few thousand
    upto = F.sum("n").over(group.orderBy("_step")) / F.sum("n").over(group)
    limits = steps.withColumn("_upto", upto).where(F.col("_upto") >= quantile).groupBy(F.col("lang").alias("_l"), "_held").agg((F.min("_step") / 1000).alias("_limit"))
    limits = limits.groupBy("_l").agg(F.coalesce(F.max(F.when(F.col("_held"), F.col("_limit"))), F.max("_limit")).alias("_limit"))
    joined = scored.join(F.broadcast(limits), scored["lang"].eqNullSafe(limits["_l"]), "left")  # a row per language
    kept = (F.col("n_words") > 0) & F.coalesce(F.col("_log") <= F.col("_limit"), F.lit(True))
    return joined.select("doc_id", "lang", "n_words", F.exp("_log").alias("perplexity"), F.exp("_limit").alias("threshold"), kept.alias("kept"))


def op5_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 and toxic = 0")
    return classify(docs, trusted)
