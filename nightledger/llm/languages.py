"""Language of whole texts by interpolated Kneser-Ney models of characters, one model per language.

A text is read as its letters and marks in lower case, with one blank for anything between them. The models
predict each character from the three before it. Counting is distributed: tasks count sequences of four
characters per language, a shuffle adds the counts up, and everything else follows from that table by
grouping: the lower orders count the different characters that precede a sequence, contexts their totals and
followers. The counts cover every learnable document but the calibration documents, and grow with them.

A sequence of up to four characters is packed into 64 bits, 16 to a character, and spread by a bijection, so the
sorted hash array that holds the models has no collisions. For each sequence the array holds its logarithm of
probability in every language; a second one holds what a language pays for leaving a context for a shorter one.
No sequence is left out. Beyond ``TABLE_BYTES`` the models are cut into blocks by the two characters in the middle of a sequence,
which it shares with all shorter ones and contexts that it may fall back to. One block at a time is gathered and shared, and texts pass
the blocks one after the other, each adding the logarithms of its own characters.

The language with the lowest cross-entropy per character is chosen. Scores and the bound beyond which a text is rejected as no text
of its language are fitted on the calibration documents, which the counts leave out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, StructField, StructType

from nightledger.llm.folds import held_out
from nightledger.llm.frames import Carried, cut_lineage
from nightledger.llm.words import mix, slabs

ORDER = 4
TABLE_BYTES = 32 << 20  # of a block of the models
LEAST_ROWS = 1024  # of a block
CALIBRATION = 4000  # documents, a tenth of the learnable ones at most
MOST_LANGUAGES = 1024
HELD_ENTRIES = 4 << 20  # sequences a counting task holds before it hands them on
SLAB = 1 << 20
UNKNOWN = "und"
BLANK = 0x20
_LETTERS_END = 0x32400  # no letters are assigned beyond

_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each code point, 0 for what is neither letter nor mark, and whether it is a letter."""
    if not _tables:
        symbol, letter = np.zeros(_LETTERS_END + 1, np.uint16), np.zeros(_LETTERS_END + 1, bool)
        for point in range(_LETTERS_END):
            kind = unicodedata.category(chr(point))[0]
            if kind in "LM":
                lower = chr(point).lower()
                own = ord(lower) if len(lower) == 1 else point
                symbol[point] = own if own < 0xFFFF else 0xFFFF  # letters beyond 16 bits share a symbol
                letter[point] = kind == "L"
        _tables.append((symbol, letter))
    return _tables[0]


class Symbols:
    """Sequences of several texts: ``keys`` packs each character with the ``ORDER - 1`` before it, ``text`` owns it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        symbol, letter = _letters()
        point = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        if starts[-1] != len(point):  # broken bytes: text by text
            parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            point = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        texts = len(offsets) - 1
        point = np.minimum(point, _LETTERS_END)
        owner = np.repeat(np.arange(texts), np.diff(starts))
        self.letters = np.bincount(owner[letter[point]], minlength=texts) > 0
        symbols = symbol[point]
        known = np.flatnonzero(symbols)
        head = np.ones(len(known), bool)
        head[1:] = (known[1:] != known[:-1] + 1) | (owner[known[1:]] != owner[known[:-1]])
        # one blank before every run of letters, and one after the last run of a text
        words = np.flatnonzero(head)
        last = np.ones(len(words), bool)
        last[:-1] = owner[known[words[1:]]] != owner[known[words[:-1]]]
        ends = np.append(words[1:], len(known))[last]
        at = np.concatenate([words, ends])
        value = np.full(len(at), BLANK, np.uint16)
        whose = np.concatenate([owner[known[words]], owner[known[words[last]]]]) if len(words) else owner[:0]
        order = np.lexsort((np.arange(len(at)) < len(words), at))  # an end comes before the next text's first blank
        stream = np.insert(symbols[known], at[order], value)
        self.text = np.insert(owner[known], at[order], whose[order])
        first = np.ones(len(stream), bool)
        first[1:] = self.text[1:] != self.text[:-1]
        place = np.arange(len(stream)) - np.maximum.accumulate(np.where(first, np.arange(len(stream)), 0))
        self.keys = stream.astype(np.uint64)
        for back in range(1, ORDER):
            before = np.full(len(stream), BLANK, np.uint64)
            before[back:] = stream[: len(stream) - back] if len(stream) > back else before[back:]
            before[place < back] = BLANK
            self.keys |= before << np.uint64(16 * back)
        inner = ~first  # the blank before a text is given, not predicted
        self.keys, self.text = self.keys[inner], self.text[inner]
        self.counts = np.bincount(self.text, minlength=texts)


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << 16 * order) - 1)


class HashArray:
    """Sorted spread keys with a row of numbers each, found through the leading bits."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        hashes = mix(keys.copy())
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], rows[order]
        bits = max(1, min(24, int(len(keys)).bit_length()))
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.first = np.append(np.searchsorted(self.hashes, edges), len(keys)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 for those that are absent."""
        hashes = mix(keys.copy())
        bucket = hashes >> self.shift
        at, stop = self.first[bucket], self.first[bucket + np.uint64(1)]
        out = np.full(len(keys), -1, np.int64)
        left = np.flatnonzero(at < stop)
        at = at[left]
        while len(left):
            value = self.hashes[at]
            same = value == hashes[left]
            out[left[same]] = at[same]
            on = np.flatnonzero(~same & (at + 1 < stop[left]))
            left, at = left[on], at[on] + 1
        return out


def _middle(keys: np.ndarray) -> np.ndarray:
    """The character before the last of each sequence, and the one before that in the lower 16 bits."""
    low, width = np.uint64(0xFFFF), np.uint64(16)
    return ((keys >> width & low) << width | keys >> width * np.uint64(2) & low).astype(np.int64)


@dataclass
class Model:
    """Character models of ``names``: rows of log probabilities of sequences and log weights of contexts.

    A block of them holds those of the ``middles`` from the first to the last, see :func:`_middle`; all if there is none.
    """

    names: list[str]
    middles: tuple[int, int] | None = None
    floor: np.ndarray | None = None  # log probability of a character that a language has not seen
    grams: dict[int, HashArray] = field(default_factory=dict)
    leaving: dict[int, HashArray] = field(default_factory=dict)
    sharpness: float = 1.0
    doubt: float = 0.0
    middle: np.ndarray | None = None
    spread: np.ndarray | None = None
    bound: float = np.inf

    def logs(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of the last character of each sequence in every language, by its longest known part."""
        out = np.zeros((len(keys), len(self.names)), np.float32)
        left = np.arange(len(keys))
        for size in range(order, 0, -1):
            own = _suffix(keys[left], size)
            at = self.grams[size].find(own)
            known = at >= 0
            out[left[known]] += self.grams[size].rows[at[known]]
            left, own = left[~known], own[~known]
            if not len(left):
                return out
            if size > 1:
                at = self.leaving[size].find(own >> np.uint64(16))
                known = at >= 0
                out[left[known]] += self.leaving[size].rows[at[known]]
        out[left] += self.floor
        return out

    def sums(self, symbols: Symbols) -> np.ndarray:
        """Sum of the logs of each text's characters in every language, of those whose sequence is of this block."""
        total, keys, text = np.zeros((len(symbols.counts), len(self.names))), symbols.keys, symbols.text
        if self.middles is not None:
            middle = _middle(keys)
            mine = (self.middles[0] <= middle) & (middle <= self.middles[1])
            keys, text = keys[mine], text[mine]
        if self.names and len(keys):
            have = np.unique(text)
            start = np.searchsorted(text, have)
            total[have] = np.add.reduceat(self.logs(keys), start, axis=0, dtype=np.float64)
        return total

    def entropies(self, symbols: Symbols) -> np.ndarray:
        """Cross-entropy per character of each text in every language, 0 for texts without characters."""
        return _entropies(self.sums(symbols), symbols.counts)

    def judge(self, symbols: Symbols, entropy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language (-1 where a text has no letter), score and rejection of each text."""
        n = symbols.counts
        if not self.names:
            return np.full(len(n), -1), np.zeros(len(n)), np.ones(len(n), bool)
        choice = entropy.argmin(1)
        score = _posterior(entropy, n, self.sharpness, self.doubt)[np.arange(len(n)), choice]
        rejected = _excess(entropy[np.arange(len(n)), choice], n, choice, self.middle, self.spread) > self.bound
        choice = np.where(symbols.letters, choice, -1)
        return choice, np.where(choice >= 0, score, 0.0), rejected | (choice < 0)


def _entropies(sums: np.ndarray, n: np.ndarray) -> np.ndarray:
    return -sums / np.maximum(n, 1)[:, None]


def _posterior(entropy: np.ndarray, n: np.ndarray, sharpness: float, doubt: float) -> np.ndarray:
    """Share of each language: evidence grows with the root of the length, as characters depend on each other."""
    power = -entropy * sharpness * np.sqrt(n)[:, None]
    power = np.exp(power - power.max(1, keepdims=True))
    return (1 - doubt) * power / power.sum(1, keepdims=True) + doubt / entropy.shape[1]


def _excess(entropy, n, choice, middle, spread) -> np.ndarray:
    """Deviations by which a cross-entropy lies above its language's mean, for texts of its length."""
    return (entropy - middle[choice]) / np.sqrt(spread[choice, 0] + spread[choice, 1] / np.maximum(n, 1))


def calibrate(model: Model, truth: np.ndarray, entropy: np.ndarray, n: np.ndarray) -> None:
    """Fit scores and rejection on texts of known language.

    ``sharpness`` has the highest likelihood among powers of two, ``doubt`` is the share of wrong choices. The variance
    of a cross-entropy is a constant plus a part that falls with the length, by least squares; the bound is
    half as far again as the 999th of 1000 texts lies, at least six deviations.
    """
    size = len(model.names)
    model.middle, model.spread = np.zeros(size), np.ones((size, 2))
    if not len(truth):
        model.doubt = 0.5
        return
    choice = entropy.argmin(1)
    model.doubt = (np.count_nonzero(choice != truth) + 1) / (len(truth) + 2)
    own = np.arange(len(truth))

    def loss(sharpness: float) -> float:
        return -np.log(_posterior(entropy, n, sharpness, model.doubt)[own, truth]).sum()

    model.sharpness = min((2.0**k for k in range(-6, 7)), key=loss)
    right = choice == truth
    every = entropy[own, truth][right]
    for language in range(size):
        mine = every[truth[right] == language]
        sizes = n[right][truth[right] == language]
        few = len(mine) < 8
        mine, sizes = (every, n[right]) if few else (mine, sizes)
        if not len(mine):
            continue
        model.middle[language] = np.median(mine)
        square = (mine - model.middle[language]) ** 2
        inverse = 1 / np.maximum(sizes, 1)
        slope = max(0.0, np.cov(inverse, square, bias=True)[0, 1] / max(inverse.var(), 1e-12))
        model.spread[language] = max(square.mean() - slope * inverse.mean(), 1e-4), slope
    if len(every):
        over = _excess(every, n[right], truth[right], model.middle, model.spread)
        model.bound = max(6.0, 1.5 * float(np.quantile(over, 0.999)))


def _count(texts: DataFrame, names: list[str]) -> DataFrame:
    """language (number), key and n of every sequence of ``ORDER`` characters of ``texts`` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        entries = 0
        number = {name: i for i, name in enumerate(names)}

        def rows(language: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            columns = [np.full(len(keys), language, np.int32), keys.view(np.int64), n]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["language", "key", "n"])

        for batch in batches:
            languages = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for lo, hi, data, offsets in slabs(batch.column("text"), SLAB):
                symbols = Symbols(data, offsets)
                language = languages[lo:hi][symbols.text]
                for own in np.unique(language):
                    keys, n = np.unique(symbols.keys[language == own], return_counts=True)
                    held.setdefault(int(own), []).append((keys, n))
                    entries += len(keys)
                if entries > HELD_ENTRIES:
                    held = {own: [_added(parts)] for own, parts in held.items()}
                    entries = sum(len(parts[0][0]) for parts in held.values())
                    if entries > HELD_ENTRIES // 2:
                        for own, parts in held.items():
                            yield rows(own, *parts[0])
                        held, entries = {}, 0
        for own, parts in held.items():
            yield rows(own, *_added(parts))

    counted = texts.mapInArrow(count, "language int, key long, n long")
    return counted.groupBy("language", "key").agg(F.sum("n").alias("n"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)


def _discounted(counts: DataFrame) -> DataFrame:
    """Counts with the share of their context that stays after the discount and the share that is left over."""
    once, twice = F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long"))
    rate = F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5)
    rates = counts.groupBy("language").agg(rate.alias("rate"))
    context = F.shiftrightunsigned("key", 16).alias("context")
    contexts = counts.groupBy("language", context).agg(F.sum("n").alias("total"), F.count("*").alias("followers"))
    out = counts.withColumn("context", F.shiftrightunsigned("key", 16)).join(contexts, ["language", "context"])
    out = out.join(F.broadcast(rates), "language")  # one row per language, at most MOST_LANGUAGES
    return out.select(
        "language",
        "key",
        "context",
        "n",
        (F.greatest(F.col("n") - F.col("rate"), F.lit(0.0)) / F.col("total")).alias("own"),
        (F.col("rate") * F.col("followers") / F.col("total")).alias("over"),
    )


def _least(counts: DataFrame, most: int) -> int:
    """The smallest count so that at most ``most`` rows have it or more."""
    sizes = counts.groupBy("n").agg(F.count("*").alias("rows"))
    total, least = 0, 1
    top = sizes.orderBy(F.desc("n")).limit(most + 1).collect()  # distinct counts fall off fast: few rows
    for row in top:
        total += row.rows
        if total > most:
            least = row.n + 1
            break
    return least


def _tables_of(counts: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame], int]:
    """Per order: (language, key, log probability) and (language, context, log weight), the first without context; number of characters.

    The counts of an order below the highest are the numbers of different characters before a sequence. Every sequence counted
    is there.
    """
    by_order = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("key").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("key")
        by_order[order] = cut_lineage(by_order[order + 1].groupBy("language", shorter).agg(F.count("*").alias("n")))
    characters = by_order[1].select("key").distinct().count()
    grams, leaving, lower = {}, {}, None
    for order in range(1, ORDER + 1):
        found = _discounted(by_order[order])
        if lower is None:
            found = found.withColumn("below", F.lit(1.0 / (characters + 1)))
        else:
            shorter = F.col("key").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))
            below = lower.select("language", F.col("key").alias("shorter"), F.col("p").alias("below"))
            found = found.withColumn("shorter", shorter).join(below, ["language", "shorter"])
        found = found.withColumn("p", F.col("own") + F.col("over") * F.col("below"))
        lower = found = cut_lineage(found.select("language", "key", "context", "over", "p"))
        grams[order] = found.select("language", "key", F.log("p").alias("value"))
        contexts = found.groupBy("language", F.col("context").alias("key")) if order > 1 else found.groupBy("language")
        leaving[order] = contexts.agg(F.log(F.first("over")).alias("value"))
    return grams, leaving, characters


def _middle_of(skipped: int) -> tuple[Column, Column]:
    """The two characters of :func:`_middle` of sequences (``skipped`` 1) or of contexts, which lack the last one (0)."""
    before = F.shiftrightunsigned("key", 16 * skipped)
    return before.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(before, 16).bitwiseAND(F.lit(0xFFFF))


def _ranges(grams: dict[int, DataFrame], leaving: dict[int, DataFrame], most: int) -> list[tuple[int, int] | None]:
    """Ranges of middles that together are all, of about ``most`` rows of the tables each, or one middle; None if all fit.

    The rows are counted by the character before the last, and by both characters for those that have more than ``most``.
    """
    rows = None
    for order in range(2, ORDER + 1):
        for table, skipped in ((grams[order], 1), (leaving[order], 0)):
            last, earlier = _middle_of(skipped)
            part = table.select(last.alias("last"), (earlier if order > 2 else F.lit(0).cast("long")).alias("earlier"))
            rows = part if rows is None else rows.union(part)
    pairs = cut_lineage(rows.groupBy("last", "earlier").agg(F.count("*").alias("n")))
    single = pairs.groupBy("last").agg(F.sum("n").alias("n"))
    whole = single.where(F.col("n") <= most).collect()  # at most as many as characters of 16 bits
    heavy = pairs.join(single.where(F.col("n") > most).select("last"), "last").collect()
    if not heavy and sum(r.n for r in whole) <= most:
        return [None]
    starts, held = [], most + 1
    for at, n in sorted([(r.last << 16, r.n) for r in whole] + [(r.last << 16 | r.earlier, r.n) for r in heavy]):
        if held + n > most:
            starts.append(at)
            held = 0
        held += n
    starts[0] = 0
    return list(zip(starts, [*(s - 1 for s in starts[1:]), (1 << 32) - 1], strict=True))


def _within(rows: DataFrame, order: int, skipped: int, middles: tuple[int, int] | None) -> DataFrame:
    """Rows of a table that sequences of these middles may ask for."""
    if middles is None or order - skipped < 1:
        return rows
    last, earlier = _middle_of(skipped)
    if order == 2:  # shared by all middles with this character before the last
        return rows.where(last.between(middles[0] >> 16, middles[1] >> 16))
    return rows.where((last * (1 << 16) + earlier).between(*middles))


def _pivot(rows: DataFrame, n_languages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with a row of values per language, and which of them are given."""
    got = rows.select("language", "key", F.col("value").cast("float")).toArrow()
    key = got.column("key").to_numpy().astype(np.int64).view(np.uint64)
    keys, where = np.unique(key, return_inverse=True)
    values, given = np.zeros((len(keys), n_languages), np.float32), np.zeros((len(keys), n_languages), bool)
    language = got.column("language").to_numpy()
    values[where, language], given[where, language] = got.column("value").to_numpy(), True
    return keys, values, given


def _block(grams: dict[int, DataFrame], leaving: dict[int, DataFrame], characters: int, names: list[str], middles: tuple[int, int] | None) -> Model:
    """The models, or the block of them that holds ``middles``."""
    model, size = Model(names, middles), len(names)
    model.floor = np.full(size, -np.log(characters + 1), np.float32)
    for row in leaving[1].collect():
        model.floor[row.language] += row.value
    for order in range(1, ORDER + 1):
        if order > 1:
            keys, values, _ = _pivot(_within(leaving[order], order, 0, middles), size)
            model.leaving[order] = HashArray(keys, values)
        keys, values, given = _pivot(_within(grams[order], order, 1, middles), size)
        if order == 1:
            other = np.broadcast_to(model.floor, values.shape)
        else:  # a language that lacks the sequence leaves its context for the shorter one
            other = model.logs(keys, order - 1)
            at = model.leaving[order].find(keys >> np.uint64(16))
            other[at >= 0] += model.leaving[order].rows[at[at >= 0]]
        model.grams[order] = HashArray(keys, np.where(given, values, other))
    return model


def blocks(counts: DataFrame, names: list[str], table_bytes: int = TABLE_BYTES) -> Iterator[Model]:
    """The models from counts of sequences in blocks of about ``table_bytes``, each gathered when it is asked for."""
    grams, leaving, characters = _tables_of(counts)
    for middles in _ranges(grams, leaving, max(LEAST_ROWS, table_bytes // (8 + 4 * len(names)))):
        yield _block(grams, leaving, characters, names, middles)


def build(counts: DataFrame, names: list[str], table_bytes: int | None = None) -> Model:
    """The models in one piece whatever ``table_bytes`` is; :func:`blocks` bounds what reaches the driver."""
    return _block(*_tables_of(counts), names, None)


def _through(texts: DataFrame, shared: list[Broadcast], schema: StructType, finish: Callable) -> DataFrame:
    """What ``finish`` makes of rows (with ``text``), their symbols and their cross-entropies, of all blocks together.

    One pass for each block. The sums so far go with the texts to the shared folder after each block but the last.
    """
    names, more = texts.columns, StructField("sums", ArrayType(DoubleType()))

    def passed(block: Broadcast, first: bool, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, data, offsets in slabs(batch.column("text"), SLAB):
                    rows, symbols = batch.slice(lo, hi - lo), Symbols(data, offsets)
                    total = block.value.sums(symbols)
                    if not first:
                        total += rows.column("sums").flatten().to_numpy().reshape(total.shape)
                    if last:
                        yield finish(rows, symbols, _entropies(total, symbols.counts))
                    else:
                        own = [rows.column(c) for c in names]
                        yield pa.RecordBatch.from_arrays([*own, _lists(total)], names=[*names, "sums"])

        return add

    out = texts
    for i, block in enumerate(shared):
        last = i == len(shared) - 1
        out = out.mapInArrow(passed(block, i == 0, last), schema if last else StructType([*texts.schema, more]))
        out = out if last else cut_lineage(out)
    return out


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, max(1, rows.shape[1]), np.int32), rows.ravel())


def fit(
    docs: DataFrame, mod: int, rest: int, table_bytes: int = TABLE_BYTES, calibration: int = CALIBRATION
) -> tuple[Model, list[Broadcast]]:
    """Scores and rejection, without tables, and the shared blocks of the models.

    Models are of all learnable documents, scores and rejection of at most about ``calibration`` of them.
    """
    share_out = docs.sparkSession.sparkContext.broadcast
    learnable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(mod, rest))
    sizes = learnable.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = sorted(r.lang for r in sizes)
    if not names:
        return Model([]), [share_out(Model([]))]
    share = min(0.1, calibration / sum(r.n for r in sizes))
    aside = _fraction(F.col("doc_id")) < share
    texts = learnable.select("lang", F.coalesce("text", F.lit("")).alias("text"), aside.alias("aside"))
    counts = cut_lineage(_count(texts.where("not aside").select("lang", "text"), names))
    if counts.isEmpty():
        counts = cut_lineage(_count(texts.select("lang", "text"), names))
    shared = [share_out(block) for block in blocks(counts, names, table_bytes)]

    def measure(rows: pa.RecordBatch, symbols: Symbols, entropy: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(symbols.letters)
        lang = rows.column("lang").take(pa.array(some))
        return pa.RecordBatch.from_arrays([lang, _lists(entropy[some]), pa.array(symbols.counts[some])], names=["lang", "entropy", "n"])

    schema = StructType.fromDDL("lang string, entropy array<double>, n long")
    got = _through(texts.where("aside").select("lang", "text"), shared, schema, measure).toArrow()
    truth = np.array([names.index(x) for x in got.column("lang").to_pylist()], np.int64)
    entropy = np.array(got.column("entropy").to_pylist(), np.float64).reshape(len(truth), len(names))
    model = Model(names)
    calibrate(model, truth, entropy, got.column("n").to_numpy())
    return model, shared


def _fraction(value: Column) -> Column:
    """A number from 0 to 1 that a value's hash gives."""
    return F.pmod(F.xxhash64(value.cast("string"), F.lit(13)), F.lit(1 << 20)) / float(1 << 20)


def identified(docs: DataFrame, mod: int = 4, rest: int = 2, **options: int) -> DataFrame:
    """The columns of ``docs`` with held_out, lang_pred, score and rejected; columns of these names are replaced.

    Learns from text and lang of the documents whose crc32 of the id as text leaves another rest than ``rest``, and
    predicts every text from its text only. ``lang_pred`` is a learned language, ``und`` for null texts and texts without
    a letter, and for all if nothing can be learned; their score is 0. ``rejected`` marks texts that are unlikely to
    be in any learned language, and all of ``und``. A null id is neither held out nor learned from; a null language is
    not learned from; repeated rows count and are predicted each. Equal cross-entropies go to the smaller name.
    """
    learnt = docs.select(F.col("doc_id"), F.col("text"), F.col("lang").cast("string").alias("lang"))
    scores, shared = fit(learnt, mod, rest, **options)
    carried = Carried(docs, "doc_id", "text")
    more = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    schema = carried.schema(*more)

    def predict(rows: pa.RecordBatch, symbols: Symbols, entropy: np.ndarray) -> pa.RecordBatch:
        names = pa.array([*scores.names, UNKNOWN], pa.string())
        choice, score, rejected = scores.judge(symbols, entropy)
        chosen = names.take(pa.array(np.where(choice < 0, len(scores.names), choice)))
        old = [rows.column(c) for c in ("row", "doc_id", "text")]
        return pa.RecordBatch.from_arrays([*old, chosen, pa.array(score), pa.array(rejected)], names=schema.names)

    out = _through(carried.work, shared, schema, predict)
    return carried.back(out, {"held_out": held_out(mod, rest)} | {f.name: F.col(f.name) for f in more})
