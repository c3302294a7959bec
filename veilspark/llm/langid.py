"""Language identification by Kneser-Ney character models (operator 3).

Texts are lower-cased; each run of characters that are no letters counts as one
space.  Per language an interpolated Kneser-Ney model of order 4 gives every
character's probability after the three before it:

    P_k(c | h) = (n(hc) - D) / n(h.) + D * kinds(h.) / n(h.) * P_k-1(c | h')

n counts occurrences at the highest order and, below, the different characters
seen before the gram; D = n1 / (n1 + 2 n2) per order and language; below the
first order stands the uniform law over all characters seen and one more.
All seen grams of orders 1 to 4 (with P) and contexts (with the weight of the
shorter history) of a language lie in one array sorted by a 64-bit hash, beside an
array of the logarithms, 12 bytes an entry.  Languages go to the tasks in groups
of at most ``group_entries`` entries, one pass over the texts for each group.  A
language with more is cut by the character before the last one of a gram, which
all entries that one place of a text needs have in common; the passes' sums add up.

The prediction is the language with the least cross-entropy per character.
A calibration part of the training rows, which the models never saw, gives the
factor that turns cross-entropies into probabilities (least log loss on a
grid) and, per language, the cross-entropy that all but a share ``spare`` of
its texts stay under; a text above it is marked as rejected.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import add_columns, slices
from veilspark.session import materialize

ORDER = 4
HASH_BITS = 64
UNKNOWN = "und"
_PAD = ORDER - 1
_MASK = [(1 << 16 * k) - 1 for k in range(ORDER + 1)]
#: Primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


@functools.cache
def _letters() -> np.ndarray:
    """Is the code point a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def stream(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grams, first, last): the packed gram that ends at each counted character, and each text's part of them.

    A gram packs four 16-bit codes, the last one lowest; letters beyond the
    basic plane share the code 0xFFFF.  Three spaces stand before each text.
    """
    sep = "\0" * _PAD
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer((sep + sep.join(lowered)).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([_PAD] + [len(t) + _PAD for t in lowered])[:-1]
    stops = starts + np.array([len(t) for t in lowered], np.int64)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of the characters between two words
    pad = np.zeros(len(codes) + 1, np.int8)
    pad[starts - _PAD] += 1
    pad[starts] -= 1
    pad = np.cumsum(pad[:-1]).astype(bool)
    keep |= pad
    kept = np.concatenate(([0], np.cumsum(keep)))
    symbols = np.where(letter, np.minimum(codes, 0xFFFF), 32)[keep].astype(np.uint64)
    grams = symbols.copy()
    for back in range(1, ORDER):
        grams[back:] |= symbols[:-back] << np.uint64(16 * back)
    return grams, kept[starts], kept[stops]


def _own(grams: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The grams of the texts, without those that end in the spaces before a text."""
    marks = np.zeros(len(grams) + 1, np.int32)
    np.add.at(marks, first, 1)
    np.add.at(marks, last, -1)
    return grams[np.cumsum(marks[:-1]) > 0]


def count_grams(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most: int = 400_000) -> DataFrame:
    """``lang``, ``gram``, ``n``: how often each packed gram occurs in the texts of each language."""

    def run(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        rows = 0

        def merged(parts):
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

        def emit():
            for lang, parts in held.items():
                keys, n = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                                                  pa.array(n)], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                langs = np.array(part.column(0).to_pylist(), object)
                texts = part.column(1).to_pylist()
                for lang in dict.fromkeys(langs):
                    ordered = np.sort(_own(*stream([texts[i] for i in np.flatnonzero(langs == lang)])))
                    if not len(ordered):
                        continue
                    cuts = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1))
                    held.setdefault(lang, []).append((ordered[cuts], np.diff(cuts, append=len(ordered))))
                    rows += len(cuts)
                if rows > 2 * most:
                    held = {lang: [merged(parts)] for lang, parts in held.items()}
                    rows = sum(len(parts[0][0]) for parts in held.values())
                    if rows > most:
                        yield from emit()
                        rows = 0
        yield from emit()

    rows = docs.select(F.col(lang_col).cast("string"), text_col).mapInArrow(run, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _hash(keys: np.ndarray, kind: int) -> np.ndarray:
    """Spark's xxhash64(kind, key)."""
    def rotl(x, r):
        return x << np.uint64(r) | x >> np.uint64(64 - r)

    def one(x, seed):
        h = seed + _P5 + np.uint64(8)
        h = rotl(h ^ rotl(x * _P2, 31) * _P1, 27) * _P1 + _P4
        h = (h ^ h >> np.uint64(33)) * _P2
        h = (h ^ h >> np.uint64(29)) * _P3
        return h ^ h >> np.uint64(32)

    with np.errstate(over="ignore"):
        seed = one(np.array([kind], np.uint64), np.array([42], np.uint64))
        return one(keys, seed).view(np.int64)


def entries(grams: DataFrame) -> DataFrame:
    """``lang``, ``near``, ``slot``, ``value``: the logarithms that the models need, by hash.

    Kinds 1 to 4 are grams with P, kinds 6 to 8 the contexts of orders 2 to 4
    with the shorter history's weight, kind 5 the probability of a character
    never seen.  ``near`` is the character before the last one, null for kinds 1 and 5.
    """
    counts = {ORDER: grams.select("lang", F.col("gram").alias("key"), F.col("n").alias("c"))}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = materialize(counts[k + 1].groupBy("lang", F.col("key").bitwiseAND(F.lit(_MASK[k])).alias("key"))
                                .agg(F.count("*").alias("c")), "langid-counts")
    symbols = counts[1].select("key").distinct().count() + 1
    parts, lower = [], None
    for k in range(1, ORDER + 1):
        with_context = counts[k].withColumn("ctx", F.shiftrightunsigned("key", 16))
        sums = with_context.groupBy("lang", "ctx").agg(F.sum("c").alias("s"), F.count("*").alias("kinds"))
        ones = counts[k].groupBy("lang").agg(F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"))
        # Without grams of one or two occurrences the formula says nothing: a half.
        d = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
        sums = sums.join(ones.select("lang", d.alias("d")), "lang").withColumn("weight", F.col("d") * F.col("kinds") / F.col("s"))
        rows = with_context.join(sums, ["lang", "ctx"])
        if lower is None:
            rows = rows.withColumn("below", F.lit(1.0 / symbols))
        else:
            rows = rows.withColumn("short", F.col("key").bitwiseAND(F.lit(_MASK[k - 1]))).join(
                lower.select("lang", F.col("key").alias("short"), F.col("p").alias("below")), ["lang", "short"])
        p = (F.col("c") - F.col("d")) / F.col("s") + F.col("weight") * F.col("below")
        lower = materialize(rows.select("lang", "key", p.alias("p")), "langid-order")
        parts.append(lower.select("lang", F.lit(k).cast("long").alias("kind"), "key", F.ln("p").alias("value")))
        weight = F.ln(F.col("weight") / symbols) if k == 1 else F.ln("weight")
        parts.append(sums.select("lang", F.lit(ORDER + k).cast("long").alias("kind"), F.col("ctx").alias("key"), weight.alias("value")))
    every = functools.reduce(DataFrame.unionByName, parts)
    near = (F.when(F.col("kind").between(2, ORDER), F.shiftrightunsigned("key", 16)).when(F.col("kind") > ORDER + 1, F.col("key"))
            .bitwiseAND(F.lit(_MASK[1])))
    return materialize(every.select("lang", near.alias("near"), F.xxhash64("kind", "key").alias("slot"),
                                    F.col("value").cast("float").alias("value")), "langid-model")


class Models:
    """Models of a group of languages: per language, or part of one, sorted hashes and their logarithms.

    A table may end with its part's number and how many there are; places of other parts count zero.
    """

    def __init__(self, tables: dict, memory: int = 48 << 20):
        self.tables = tables
        bits = 12
        while (8 + 4 * len(tables)) << (bits + 1) <= memory:
            bits += 1
        self.bits = bits
        # Grams met lately, by their hash: the gram, and its logarithm in each language.
        self.seen = np.zeros(1 << bits, np.uint64)
        self.known = np.zeros((len(tables), 1 << bits), np.float32)

    @staticmethod
    def _find(table: tuple, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table[0], slots), len(table[0]) - 1)
        return table[0][at] == slots, table[1][at]

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Per language (rows) the logarithm of the last character's probability after the three before."""
        gram_slots, context_slots = {}, {}
        for k in range(1, ORDER + 1):
            key = grams & np.uint64(_MASK[k])
            gram_slots[k], context_slots[k] = _hash(key, k), _hash(key >> np.uint64(16), ORDER + k)
        out = np.zeros((len(self.tables), len(grams)))
        for row, table in zip(out, self.tables.values(), strict=True):
            part, parts = table[2:] or (0, 1)
            left = np.flatnonzero((grams >> np.uint64(16) & np.uint64(_MASK[1])) % np.uint64(parts) == part)
            for k in range(ORDER, 0, -1):
                hit, value = self._find(table, gram_slots[k][left])
                row[left[hit]] += value[hit]
                left = left[~hit]
                hit, value = self._find(table, context_slots[k][left])  # of order 1: a character never seen
                row[left[hit]] += value[hit]
        return out

    def score(self, texts: list[str | None]) -> tuple[list[int], list[list[float]]]:
        """Counted characters of each text and its cross-entropy per language, in nats per character."""
        grams, first, last = stream(texts)
        slot = (grams * _P1 >> np.uint64(64 - self.bits)).astype(np.int64)
        new = np.unique(grams[self.seen[slot] != grams])
        if len(new):
            at = (new * _P1 >> np.uint64(64 - self.bits)).astype(np.int64)
            self.known[:, at] = self.log_probabilities(new)
            self.seen[at] = new
        lost = np.flatnonzero(self.seen[slot] != grams)  # two new grams of one slot
        extra = self.log_probabilities(grams[lost]) if len(lost) else None
        n = last - first
        sums = np.zeros((len(texts), len(self.tables)))
        for i in range(len(self.tables)):
            value = self.known[i][slot].astype(np.float64)
            if extra is not None:
                value[lost] = extra[i].astype(np.float32)
            # Each text on its own, so that its sum does not depend on what else the slice holds.
            sums[:, i] = [value[a:b].sum() for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        return n.tolist(), (-sums / np.maximum(n, 1)[:, None]).tolist()


def score(docs: DataFrame, model: DataFrame, text_col: str = "text", group_entries: int = 13_000_000) -> tuple[DataFrame, list[str]]:
    """``docs`` with ``n_counted`` and ``entropies`` (one for each of the returned languages, sorted)."""
    spark = docs.sparkSession
    sizes = {r.lang: (r.n, r.common, r.kinds) for r in model.groupBy("lang").agg(
        F.count("*").alias("n"), F.count_if(F.col("near").isNull()).alias("common"), F.count_distinct("near").alias("kinds")).collect()}
    groups: list[list[tuple[str, int, int]]] = []
    room = 0
    for lang in sorted(sizes):
        n, common, kinds = sizes[lang]
        # The characters seen go with each part.
        parts = 1 if n <= group_entries else max(1, min(kinds, -(-(n - common) // max(1, group_entries - common))))
        for part in range(parts):
            size = common + (n - common) // parts
            if not groups or size > room:
                groups.append([])
                room = group_entries
            groups[-1].append((lang, part, parts))
            room -= size
    out = docs.withColumn("entropies", F.array().cast("array<double>"))
    fields = [T.StructField("n_counted", T.LongType()), T.StructField("__more", T.ArrayType(T.DoubleType()))]
    for i, group in enumerate(groups):
        tables = {}
        chosen = functools.reduce(Column.__or__, [(F.col("lang") == lang) & (
            F.col("near").isNull() | (F.col("near") % parts == part)) for lang, part, parts in group])
        rows = model.filter(chosen).select("lang", F.coalesce("near", F.lit(-1)).alias("near"), "slot", "value").toArrow()
        for lang, part, parts in group:
            own = rows.filter(pa.compute.equal(rows["lang"], lang))
            near, slots, values = (own[c].to_numpy() for c in ("near", "slot", "value"))
            mine = np.flatnonzero((near < 0) | (near % parts == part))
            mine = mine[np.argsort(slots[mine])]
            tables[lang, part] = slots[mine], values[mine], part, parts
        sent = spark.sparkContext.broadcast(tables)

        def start(sent=sent):
            return Models(sent.value).score

        out = add_columns(out, text_col, fields, start, slice_bytes=1 << 20)
        out = out.withColumn("entropies", F.concat("entropies", "__more")).drop("__more")
        if i + 1 < len(groups):
            out = materialize(out, "langid-scores")
    held = [lang for group in groups for lang, _, _ in group]
    if len(held) > len(sizes):
        out = out.withColumn("entropies", F.array(*[
            functools.reduce(Column.__add__, [F.get("entropies", F.lit(i)) for i, x in enumerate(held) if x == lang])
            for lang in sorted(sizes)]))
    if not groups:
        out = out.withColumn("n_counted", F.lit(0).cast("long"))
    return out, sorted(sizes)


def identify(docs: DataFrame, train: str, calibrate: str, lang_col: str = "lang", text_col: str = "text",
             keep: list[str] | None = None, spare: float = 0.001) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with ``lang_pred``, ``score``, ``cross_entropy`` and ``rejected``.

    ``train`` and ``calibrate`` are SQL conditions that choose the rows to learn
    from; of these only those with a language count.  Models of the former, tried on
    the latter, give the calibration; the models that predict learn from both.  ``score`` is the
    calibrated probability of the prediction.  Texts that are null or have no
    letter get ``und``, score 0 and no cross-entropy, as do all texts if
    nothing was learned.  Equal cross-entropies go to the language that sorts
    first.  A language without calibration rows rejects nothing.  Every row
    gives one row; a column that has the name of an output is replaced.
    """
    outputs = ("lang_pred", "score", "cross_entropy", "rejected")
    keep = [c for c in (keep or docs.columns) if c.lower() not in outputs]
    held = {f"__k{i}": c for i, c in enumerate(dict.fromkeys(keep))}
    labelled = docs.filter(F.col(lang_col).isNotNull())
    learned, tried = (F.coalesce(F.expr(c), F.lit(False)) for c in (train, calibrate))
    part = materialize(count_grams(labelled.filter(learned), lang_col, text_col), "langid-grams")
    rest = materialize(count_grams(labelled.filter(tried & ~learned), lang_col, text_col), "langid-grams")

    def scored_by(rows: DataFrame, grams: DataFrame) -> tuple[DataFrame, list[str]]:
        scored, langs = score(rows, entries(grams), "__text")
        scored = scored.drop("__text").withColumn("cross_entropy", F.when(F.col("n_counted") > 0, F.array_min("entropies")))
        return materialize(scored, "langid-scored"), langs

    def odds(factor):
        """Sum over the languages of exp(factor * (least - own)): the inverse of the prediction's probability."""
        return F.aggregate("entropies", F.lit(0.0), lambda a, x: a + F.exp(F.lit(factor) * (F.col("cross_entropy") - x)))

    # Calibrated on rows that these models have not seen; then models of all rows that may be learned from.
    sample, langs = scored_by(labelled.filter(tried).select(F.col(text_col).alias("__text"), F.col(lang_col).cast("string").alias("__lang")), part)
    names = F.array(*[F.lit(x) for x in langs]).cast("array<string>")
    sample = sample.filter("cross_entropy is not null").withColumn(
        "own", F.get("entropies", F.array_position(names, F.col("__lang")).cast("int") - 1)).filter("own is not null")
    grid = [2.0 ** (i / 2) for i in range(-2, 19)]
    losses = sample.agg(*[F.avg(F.lit(b) * (F.col("own") - F.col("cross_entropy")) + F.ln(odds(b))) for b in grid]).first()
    known = [(loss, b) for loss, b in zip(losses, grid, strict=True) if loss is not None]
    factor = min(known)[1] if known else 1.0
    limits = sample.filter("own = cross_entropy").groupBy(F.col("__lang").alias("of")).agg(
        F.percentile_approx("cross_entropy", 1 - spare, 10_000).alias("limit"))
    rows = docs.select(*[F.col(c).alias(k) for k, c in held.items()], F.col(text_col).alias("__text"))
    grams = part
    if not rest.isEmpty():
        grams = materialize(part.unionByName(rest).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-grams")
    scored, langs = scored_by(rows, grams)
    names = F.array(*[F.lit(x) for x in langs]).cast("array<string>")
    scored = scored.withColumn("lang_pred", F.when(
        F.col("cross_entropy").isNotNull(), F.get(names, F.array_position("entropies", F.col("cross_entropy")) - 1)))
    out = scored.join(limits, F.col("lang_pred") == F.col("of"), "left")
    return out.select(
        *[F.col(k).alias(c) for k, c in held.items()],
        F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("lang_pred").isNull(), 0.0).otherwise(1 / odds(factor)).alias("score"),
        "cross_entropy", F.coalesce(F.col("cross_entropy") > F.col("limit"), F.lit(False)).alias("rejected"))
