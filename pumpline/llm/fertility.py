"""Quality rules from tokeniser fertility.

Public vocabularies measure every text: characters per token under a
vocabulary with byte fallback and under a byte-level one, the share of
byte-fallback tokens, and the entropy of the token distribution against its
largest possible value.  Normal prose of one language and length lies in a
narrow band of each; symbol noise, repetition and broken encodings do not.

The bands come from all distinct texts: per group (language, or script where
the language is not known) and size class (powers of two of the token count)
the quartiles of each measure, widened by ``WIDTH`` times the distance from the
median to the quartile.  However often a text is repeated, it counts once.
Groups with under ``LEAST`` texts in a class use the group's own bands over all
classes; groups that small use those of their script, and scripts that small
those of all texts.  Only an input with under ``LEAST`` texts has no bands.

Words are encoded one by one (neither vocabulary joins words), so each
distinct word of a task is encoded once.  Plain counts (words, symbols,
repeated lines and 8-word windows) give a verdict before the bands.
"""

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpline.llm.common import IS_SPACE, WordHash, mix, segments, stored, utf8, word_spans

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WIDTH = 5.0
LEAST = 50
KNOWN_WORDS = 250_000
MEASURES = ("chars_per_token", "chars_per_byte_token", "fallback_share", "entropy")

BASE = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")]
RESULT = T.StructType(BASE + [T.StructField(n, T.DoubleType()) for n in MEASURES])


class Vocabularies:
    """Token ids of words under both vocabularies, remembered by word hash."""

    def __init__(self, piece_path: str, byte_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        with open(byte_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.fallback = np.array([self.pieces.IsByte(i) for i in range(self.pieces.GetPieceSize())])
        self.clear()

    def clear(self) -> None:
        self.row: dict[int, int] = {}
        self.ids: list[np.ndarray] = []
        self.n_bytes: list[int] = []

    def rows(self, hashes: np.ndarray, word) -> np.ndarray:
        """The row of each hash; ``word(i)`` gives the bytes of the i-th."""
        if len(self.row) + len(hashes) > KNOWN_WORDS and self.row:
            self.clear()
        listed = hashes.tolist()
        fresh = [i for i, h in enumerate(listed) if h not in self.row]
        for at in range(0, len(fresh), 20_000):
            some = fresh[at:at + 20_000]
            words = [word(i).decode("utf-8", "replace") for i in some]
            for i, ids, n in zip(some, self.pieces.encode(words, num_threads=1), [self.bytes.encode_ordinary(" " + w) for w in words]):
                self.row[listed[i]] = len(self.ids)
                self.ids.append(np.array(ids, dtype=np.int32))
                self.n_bytes.append(len(n))
        return np.array([self.row[h] for h in listed], dtype=np.int64)


def plain_counts(text: memoryview, hashes: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of one UTF-8 text
    whose words have the given hashes."""
    chars = symbols = 0
    for at in range(0, len(text), 1 << 20):
        part = np.frombuffer(text[at:at + (1 << 20)], dtype=np.uint8)
        chars += int(np.count_nonzero((part & 0xC0) != 0x80) - np.count_nonzero(IS_SPACE[part]))
        raw = part.tobytes()
        symbols += sum(raw.count(s) for s in SYMBOLS)
    lines = [x for x in bytes(text).split(b"\n") if x.strip()]
    repeated = 0
    if len(hashes) > WINDOW:
        n = len(hashes) - WINDOW + 1
        key = np.zeros(n, dtype=np.uint64)
        for j in range(WINDOW):
            key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n]
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        if same.any():
            again = np.zeros(n, dtype=bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            step = np.zeros(len(hashes) + 1, dtype=np.int64)
            step[:n] += again
            step[WINDOW:WINDOW + n] -= again
            repeated = int(np.count_nonzero(np.cumsum(step)[:-1]))
    return chars, symbols, len(lines) - len(set(lines)), repeated


def measure(texts: pa.Array, v: Vocabularies, hashes: WordHash) -> list[np.ndarray]:
    """The columns of ``RESULT`` for a batch."""
    data, off = utf8(texts)
    n = len(texts)
    base = np.zeros((n, 6), dtype=np.int64)
    byte_tokens, fallback, spread = np.zeros(n), np.zeros(n), np.zeros(n)
    open_row, open_hashes, open_counts = -1, [], None

    def close() -> None:
        if open_row >= 0:
            base[open_row, 1:5] = plain_counts(data[int(off[open_row]):int(off[open_row + 1])], np.concatenate(open_hashes))
            c = open_counts[open_counts > 0]
            spread[open_row] = np.log2(c.sum()) - (c * np.log2(c)).sum() / c.sum() if len(c) else 0.0

    for block in segments(data, off):
        size = np.array([e - s for _, s, e in block])
        ends = np.cumsum(size + 1) - 1
        raw = b" ".join(data[s:e] for _, s, e in block) + b" "
        buf = np.frombuffer(raw, dtype=np.uint8)
        first, last = word_spans(buf)
        h = hashes.spans(buf, first, last)
        cuts = np.searchsorted(first, np.stack([ends - size, ends]))
        distinct, at, where = np.unique(h, return_index=True, return_inverse=True)
        known = v.rows(distinct, lambda i: raw[first[at[i]]:last[at[i]]])
        length = np.array([len(v.ids[r]) for r in known.tolist()], dtype=np.int64)
        n_bytes = np.array([v.n_bytes[r] for r in known.tolist()], dtype=np.int64)
        tokens = np.concatenate([v.ids[r] for r in known.tolist()] or [np.zeros(0, dtype=np.int32)])
        begin = np.cumsum(length) - length
        for (row, _, _), lo, hi in zip(block, *cuts.tolist()):
            if row != open_row:
                close()
                open_row, open_hashes, open_counts = row, [], np.zeros(len(v.fallback), dtype=np.int64)
            own = where[lo:hi]
            open_hashes.append(h[lo:hi])
            words, times = np.unique(own, return_counts=True)
            some = length[words]
            place = np.repeat(begin[words] - (np.cumsum(some) - some), some) + np.arange(some.sum())
            np.add.at(open_counts, tokens[place], np.repeat(times, some))
            base[row, 0] += hi - lo
            base[row, 5] += int((some * times).sum())
            byte_tokens[row] += (n_bytes[words] * times).sum()
            fallback[row] += (np.repeat(times, some) * v.fallback[tokens[place]]).sum()
    close()
    n_tokens = np.maximum(base[:, 5], 1)
    return [*base.T, base[:, 1] / n_tokens, base[:, 1] / np.maximum(byte_tokens, 1), fallback / n_tokens,
            np.where(base[:, 5] > 1, spread / np.log2(np.maximum(n_tokens, 2)), 1.0)]


def with_measures(docs: DataFrame, piece_path: str, byte_path: str, text: str = "text", out: str = "fertility") -> DataFrame:
    """``docs`` (a column of the name ``out`` is replaced) with a struct column ``out`` of the counts and measures; null
    and empty texts have no words and no tokens."""

    @F.arrow_udf(RESULT)
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v, hashes = Vocabularies(piece_path, byte_path), WordHash()
        for texts in batches:
            yield pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in measure(texts, v, hashes)], [f.name for f in RESULT])

    return docs.withColumn(out, measured(F.coalesce(F.col(text), F.lit(""))))


def first_letter(text: Column) -> Column:
    """The first letter of a text, empty without one."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"(\p{L})", 1)


def script(letter: Column) -> Column:
    """The script of a letter, of those told apart here."""
    named = F.when(letter == "", F.lit("none"))
    for name in ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Han", "Hiragana", "Katakana", "Hangul", "Thai"):
        named = named.when(letter.rlike(rf"\p{{Is{name}}}"), F.lit(name))
    return named.otherwise(F.lit("other"))


def _bands(df: DataFrame, by: list[str], least: int, width: float) -> DataFrame:
    rows = df.groupBy(*by).agg(F.count("*").alias("n"), *[F.percentile_approx(m, [0.25, 0.5, 0.75], 2000).alias(m) for m in MEASURES]).where(F.col("n") >= least)
    return rows.select(*by, F.struct(*[F.struct((F.col(m)[1] - width * (F.col(m)[1] - F.col(m)[0]) - 0.02).alias("low"),
                                                (F.col(m)[1] + width * (F.col(m)[2] - F.col(m)[1]) + 0.02).alias("high")).alias(m)
                                       for m in MEASURES]).alias("band"))


def judge(docs: DataFrame, piece_path: str, byte_path: str, key: str = "doc_id", text: str = "text", lang: str = "lang",
          least: int = LEAST, width: float = WIDTH) -> DataFrame:
    """One row per row of ``docs``: ``key``, the counts and measures,
    base_failed (under 20 words, or over 30 % of words in repeated windows) and
    kept (not base_failed and every measure inside its band; a measure without
    a band passes)."""
    rows = with_measures(docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l"), F.xxhash64(text).alias("h"),
                                     first_letter(F.col(text)).alias("letter")), piece_path, byte_path, "t", "f")
    rows = rows.withColumn("script", F.concat(F.lit("script:"), script(F.col("letter"))))
    rows = stored(rows.select("k", "h", "script", F.coalesce("l", "script").alias("grp"), "f.*")
                  .withColumn("cls", F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")), "fertility")
    # Copies of a text have the same measures: one of them counts.
    usable = stored(rows.where(F.col("n_words") >= MIN_WORDS).select("grp", "script", "cls", "h", *MEASURES).dropDuplicates(["grp", "h"]), "fertility-texts")
    once = usable.dropDuplicates(["h"])
    fine = _bands(usable, ["grp", "cls"], least, width)
    coarse = _bands(usable, ["grp"], least, width).withColumnRenamed("band", "wide")
    scripts = _bands(once, ["script"], least, width).withColumnRenamed("band", "of_script")
    every = _bands(once.withColumn("all", F.lit(1)), ["all"], least, width).select(F.col("band").alias("of_all"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    inside = F.lit(True)
    for m in MEASURES:
        band = F.coalesce("band", "wide", "of_script", "of_all")
        inside = inside & F.coalesce(F.col(m).between(band[m]["low"], band[m]["high"]), F.lit(True))
    return (rows.join(stored(fine, "fertility-bands"), ["grp", "cls"], "left").join(stored(coarse, "fertility-wide"), "grp", "left")
            .join(stored(scripts, "fertility-scripts"), "script", "left").join(F.broadcast(stored(every, "fertility-all")), F.lit(True), "left")
            .select(F.col("k").alias(key), *[f.name for f in BASE], *MEASURES, failed.alias("base_failed"), (~failed & inside).alias("kept")))
