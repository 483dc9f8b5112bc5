"""Language identification of mixed-language text.

The script of a word narrows the languages it can be in; character n-grams score it in
each of those; and Viterbi search over the words, with a penalty for each switch, labels
spans. The languages and their statistics are learned from a bounded sample of labelled rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .common import give_back, unused

#: Bounds of the sample that is learned from: labelled rows of a language, characters of all
#: (about), and characters of one text, of which longer ones are not drawn.
ROWS_A_LANGUAGE, CHARACTERS, LONGEST = 1500, 100_000_000, 200_000
#: Characters of texts that are read at once (about; a longer text is read alone).
STEP = 1 << 20
#: Letters from which on it counts how well a text fits what was learned.
FITTED = 20
#: What a switch between languages costs, in units of a word's log probability.
SWITCH = 6.0
ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 15
WORD = re.compile(r"[^\W\d_]+")
#: Where scripts begin (code points); a script is a number in this list.
SCRIPT_STARTS = np.array([0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xA00, 0xB00, 0xC00, 0xD00, 0xE00, 0xF00, 0x1000, 0x10A0, 0x1100, 0x1200, 0x1400, 0x1780, 0x1800, 0x1E00, 0x1F00, 0x2000, 0x2E80, 0x3040, 0x30A0, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0x10000, 0x20000])
#: Blocks that continue an earlier script (Latin, Hangul, Han).
SAME_SCRIPT = {0x1E00: 0x0, 0x1F00: 0x370, 0xAC00: 0x1100, 0x3400: 0x2E80, 0xF900: 0x2E80, 0x20000: 0x2E80}
_SCRIPT = np.array([int(np.searchsorted(SCRIPT_STARTS, SAME_SCRIPT.get(int(s), int(s)))) for s in SCRIPT_STARTS])


def scripts(words: list[str]) -> np.ndarray:
    first = np.array([ord(w[0]) for w in words], np.int64)
    return _SCRIPT[np.searchsorted(SCRIPT_STARTS, first, side="right") - 1]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(cells, starts): the table's rows that the words' n-grams and whole words have, one
    column for each order and one for the whole word; a word's cells begin at its start.
    The last row of the table stands for no n-gram."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    left = np.repeat(ends, sizes) - np.arange(len(codes))
    cells = np.full((len(codes), len(ORDERS) + 1), BUCKETS * (len(ORDERS) + 1), np.int64)
    mul, h = np.uint64(0x9E3779B97F4A7C15), np.zeros(len(codes), np.uint64)
    for k, n in enumerate(ORDERS):
        shifted = np.zeros_like(codes)
        shifted[: len(codes) - n + 1] = codes[n - 1 :]
        h = (h ^ (shifted + np.uint64(n))) * mul
        h ^= h >> np.uint64(29)
        cells[:, k] = np.where(left >= n, k * BUCKETS + (h >> np.uint64(20)) % np.uint64(BUCKETS), cells[:, k])
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    spread = (codes * mul) ^ (codes << np.uint64(17))
    whole = np.add.reduceat(spread * (np.uint64(2) * place.astype(np.uint64) + np.uint64(1)) * mul, starts)
    whole ^= whole >> np.uint64(31)
    cells[starts, -1] = len(ORDERS) * BUCKETS + (whole * mul >> np.uint64(20)) % np.uint64(BUCKETS)
    return cells, starts


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray
    by_script: np.ndarray
    prior: int
    floor: float = -np.inf  # what a letter of a known language scores on average, at least

    @classmethod
    def learned(cls, texts: list[str], langs: list[str]) -> Model:
        names = sorted(set(langs))
        many = np.zeros((BUCKETS * (len(ORDERS) + 1) + 1, len(names)))
        script = np.zeros((len(SCRIPT_STARTS) + 1, len(names)))
        rows = np.zeros(len(names))
        for i, name in enumerate(names):
            found: dict[str, int] = {}
            for t, lang in zip(texts, langs, strict=True):
                if lang == name:
                    rows[i] += 1
                    for w in WORD.findall(t.lower()):
                        found[w] = found.get(w, 0) + 1
            words = list(found)
            for at in range(0, len(words), 20_000):
                part = words[at : at + 20_000]
                count = np.array([found[w] for w in part], float)
                cells, starts = grams(part)
                each = np.repeat(count, np.diff([*starts, len(cells)]))
                for k in range(cells.shape[1]):
                    many[:, i] += np.bincount(cells[:, k], each, len(many))
                script[:, i] += np.bincount(scripts(part), count, len(script))
        table = np.zeros(many.shape, np.float32)
        for k in range(len(ORDERS) + 1):
            part = many[k * BUCKETS : (k + 1) * BUCKETS] + 0.5
            table[k * BUCKETS : (k + 1) * BUCKETS] = np.log(part / part.sum(0)) / (len(ORDERS) + 1)
        share = script / np.maximum(script.sum(0), 1)
        model = cls(names, table, share >= 0.01, int(rows.argmax()) if names else 0)
        fits = [fit for at in range(0, len(texts), 500) for _, fit, unknown, letters in model.read([WORD.findall(t) for t in texts[at : at + 500]]) if letters >= FITTED and not unknown]
        if fits:  # below what any learned text has, by half of what that is below the middle
            model.floor = float(min(fits) - (np.median(fits) - min(fits)) / 2)
        return model

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each language for each lower-case word, and what the word scores
        in the language that it fits best (NaN where no language has its script)."""
        out = np.empty((len(words), len(self.langs)), np.float32)
        peak = np.empty(len(words))
        for at in range(0, len(words), 100_000):
            part = words[at : at + 100_000]
            cells, starts = grams(part)
            total = np.zeros((len(cells), len(self.langs)), np.float32)
            for k in range(cells.shape[1]):
                total += self.table[cells[:, k]]
            s = np.add.reduceat(total, starts, axis=0)
            can = self.by_script[scripts(part)]
            s[~can & can.any(1, keepdims=True)] -= 50
            top = s.max(1, keepdims=True)
            peak[at : at + len(part)] = np.where(can.any(1), top[:, 0], np.nan)
            s[~can.any(1)] = 0
            s -= s.max(1, keepdims=True)
            out[at : at + len(part)] = np.maximum(s - np.log(np.exp(s).sum(1, keepdims=True)), -12)
        return out, peak

    def read(self, words: list[list[str]]) -> list[tuple[np.ndarray, float, bool, int]]:
        """For each text the best language number of each word, what its letters score on average in
        the languages that its words fit best, whether most letters are in scripts that no
        language has, and its letters. All texts go one word further at a time, so
        the cost of a step is shared."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        sizes = np.array([len(words[i]) for i in order])
        flat = [w.lower() for i in order for w in words[i]]
        if not flat:
            return [(np.empty(0, np.int64), 0.0, False, 0) for _ in words]
        codes, known = pd.factorize(np.array(flat, dtype=object))
        score, peak = self.scores(list(known))
        size = np.array([len(w) for w in known])
        starts = np.cumsum(sizes) - sizes
        best = np.zeros((len(sizes), len(self.langs)), np.float32)
        best[:, self.prior] = 1e-3
        came: list[tuple[np.ndarray, np.ndarray]] = []
        for t in range(int(sizes[0])):
            n = int(np.searchsorted(-sizes, -t, side="left"))  # texts longer than t
            v = best[:n]
            top = v.argmax(1)
            other = v[np.arange(n), top][:, None] - SWITCH
            came.append((top, v < other))
            best[:n] = np.maximum(v, other) + score[codes[starts[:n] + t]]
        label = np.empty(len(flat), np.int64)
        now = best.argmax(1)
        for t in range(int(sizes[0]) - 1, -1, -1):
            top, switched = came[t]
            n = len(top)
            label[starts[:n] + t] = now[:n]
            now[:n] = np.where(switched[np.arange(n), now[:n]], top, now[:n])
        out: list = [None] * len(words)
        for k, i in enumerate(order):
            own = codes[starts[k] : starts[k] + sizes[k]]
            strange = np.isnan(peak[own])
            letters, odd = int(size[own].sum()), int(size[own][strange].sum())
            fit = float(peak[own][~strange].sum() / max(letters - odd, 1))
            out[i] = label[starts[k] : starts[k] + sizes[k]], fit, 2 * odd > letters, letters
        return out


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def learn(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = ROWS_A_LANGUAGE, characters: int = CHARACTERS) -> Model:
    """A model of the rows that are not held out and have a text and a language; all languages
    are learned.

    About `rows` of each language are drawn by a seeded hash of the key, fewer where they would
    hold more than the language's part of `characters`, from texts of at most LONGEST
    characters. So the sample that reaches the driver is bounded, whatever the size of df."""
    usable = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~F.coalesce(held_out(F.col(key)), F.lit(False)) & (F.length(text) <= LONGEST))
    usable = usable.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key"))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("size")).collect()  # one row for each language
    if not counts:
        return Model([], np.zeros((1, 0)), np.zeros((1, 0)), 0)
    steps = 1 << 20
    share = [(r["lang"], int(min(1, rows / r["n"], characters / len(counts) / max(r["size"], 1)) * steps)) for r in counts]
    shares = df.sparkSession.createDataFrame(share, "lang string, share int")
    drawn = usable.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64(F.lit(9), "key"), F.lit(steps)) < F.col("share"))
    got = drawn.select("text", "lang").collect()
    return Model.learned([r[0] for r in got], [r[1] for r in got])


NAMES = ("lang_pred", "score", "spans", "known")


def identify(df: DataFrame, model: Model, text: str = "text", with_spans: bool = False, with_known: bool = False, names: tuple[str, ...] = NAMES) -> DataFrame:
    """df with lang_pred, score and, if asked for, spans (start, end, lang; in code points) and
    known; the columns are named by `names`, and columns of these names are replaced.

    lang_pred is the language of most letters and score their share. A text that is null or
    has no letter is `und` with score 0; so is every text where nothing could be learned. Only
    the text decides: equal texts get equal results. A text of letters in scripts that no
    language has gets the most frequent language learned. known is false for `und`, for a text
    most of whose letters are in such scripts, and for one whose letters score less than those
    of any text learned from by a margin; a mix of known languages is known. Rows are kept
    as they are."""
    asked = [*names[:2], *[names[2]] * with_spans, *[names[3]] * with_known]
    df = df.drop(*asked)
    held = df.sparkSession.sparkContext.broadcast(model)  # 655 kB for each language
    kind = StructType().add("lang", "string").add("score", "double")
    if with_spans:
        kind = kind.add("spans", ArrayType(StructType().add("start", "integer").add("end", "integer").add("lang", "string")))
    kind = kind.add("known", "boolean")

    # Only the text goes to Python, and only what was found comes back.
    @F.arrow_udf(kind)
    def predict(texts: pa.Array) -> pa.Array:
        size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
        # Texts of about one length are read together, as reading goes word by word.
        order = np.argsort(size, kind="stable")
        steps = np.flatnonzero(np.diff(np.cumsum(size[order]) // STEP)) + 1
        pred, score, spans, known = (np.empty(len(texts), object) for _ in range(4))
        for part in np.split(order, steps) if len(texts) else ():
            for i, (lang, share, found, fits) in zip(part.tolist(), judged(held.value, [t or "" for t in texts.take(pa.array(part)).to_pylist()]), strict=True):
                pred[i], score[i], spans[i], known[i] = lang, share, found, fits
        out = {"lang": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())}
        if with_spans:
            out["spans"] = pa.array(list(spans), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))
        out["known"] = pa.array(known, pa.bool_())
        give_back()
        return pa.StructArray.from_arrays(list(out.values()), names=list(out))

    def judged(m: Model, texts: list[str]) -> Iterator[tuple[str, float, list, bool]]:
        words = [WORD.findall(t) for t in texts]
        read = m.read(words) if m.langs else [(np.empty(0, np.int64), 0.0, True, 0)] * len(words)
        for t, own, (found, fit, strange, letters) in zip(texts, words, read, strict=True):
            if not len(found) or not any(c.isalpha() for w in own for c in w):
                yield "und", 0.0, [], False
                continue
            weight = np.bincount(found, np.fromiter(map(len, own), float, len(own)), len(m.langs))
            spans = []
            if with_spans:
                place = [x.span() for x in WORD.finditer(t)]
                cuts = [0, *(np.flatnonzero(np.diff(found)) + 1).tolist(), len(found)]
                spans = [{"start": place[i][0], "end": place[j - 1][1], "lang": m.langs[int(found[i])]} for i, j in zip(cuts, cuts[1:], strict=False)]
            yield m.langs[int(weight.argmax())], float(weight.max() / weight.sum()), spans, not strange and (letters < FITTED or fit >= m.floor)

    at = unused(df, 1, *asked)[0]
    found = dict(zip(names, ("lang", "score", "spans", "known"), strict=True))
    out = df.withColumn(at, predict(F.col(f"`{text}`")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"`{at}`.{found[c]}").alias(c) for c in asked])


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Every document's doc_id, held_out, lang_pred, score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs)
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
