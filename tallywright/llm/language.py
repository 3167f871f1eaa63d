"""Language identification by compression: per-language zstandard dictionaries of raw text, the smallest encoding wins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import apart

UND = "und"
#: The sample a dictionary is made of: this many labelled texts of a language, in hash order, up to so many bytes of each.
SAMPLE_DOCS, SAMPLE_BYTES, DICT_BYTES = 256, 2048, 1 << 17
#: Labels are split over this many salted groups before the last selection, so a frequent one is not ranked in one task.
SALTS = 32
#: A text is encoded in pieces of this many bytes, so every part of a long text meets the dictionary.
PIECE = 1 << 11
LEVEL = 6
#: rejected: the best encoding is not smaller than the second by this share.
MARGIN = 0.002


def bucket(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4


def letters(text: Column) -> Column:
    """What is encoded: the lower-cased letters of the whole text, anything between them as one space; null without a letter."""
    return F.when(text.rlike(r"\p{L}"), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")).cast("binary"))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, bytes]:
    """Dictionary content of each label, from a bounded sample of the labelled rows that are not held out.

    At most SAMPLE_DOCS rows a label reach the driver, cut to SAMPLE_BYTES; rows are ranked by a hash of the id, then
    of the text, and only hashes are ranked. Rows that repeat id and text are one. Labels are languages: few.
    """
    text = F.col(text_col)
    usable = docs.filter(F.col(lang_col).isNotNull() & text.isNotNull() & (bucket(F.col(id_col)) != 2) & text.rlike(r"\p{L}"))
    keys = [F.col(lang_col).alias("lang"), F.xxhash64(F.lit("sample"), F.col(id_col)).alias("h"), F.xxhash64(text).alias("th")]
    rows = usable.select(*keys).distinct()
    rows = rows.withColumn("salt", F.pmod("h", F.lit(SALTS)))
    salted = rows.withColumn("r", F.row_number().over(W.partitionBy("lang", "salt").orderBy("h", "th"))).filter(F.col("r") <= SAMPLE_DOCS)
    chosen = salted.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("h", "th"))).filter(F.col("r") <= SAMPLE_DOCS)
    picked = [tuple(r) for r in chosen.select("lang", "h", "th").collect()]
    content: dict[str, bytes] = {}
    if not picked:
        return content
    upto: dict[str, int] = {}
    for lang, h, _ in picked:
        upto[lang] = max(upto.get(lang, h), h)
    limit = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(h)) for lang, h in upto.items()])
    near = usable.select(*keys, text.alias("text")).filter(F.col("h") <= limit)
    known = docs.sparkSession.createDataFrame(picked, "lang string, h long, th long")
    cut = near.join(F.broadcast(known), ["lang", "h", "th"], "left_semi").withColumn("t", F.substring(letters(F.col("text")), 1, SAMPLE_BYTES))
    # rows that repeat an id and a text are one, so no more rows than were chosen reach the driver
    for r in sorted(cut.groupBy("lang", "h", "th").agg(F.min("t").alias("t")).collect(), key=lambda r: (r["lang"], r["h"], bytes(r["t"]))):
        # the end of a dictionary is reached by the shortest offsets; pieces are parted by a line end
        content[r["lang"]] = (content.get(r["lang"], b"") + b"\n" + bytes(r["t"]))[:DICT_BYTES]
    return content


def encoders(content: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for lang, data in sorted(content.items()):
        trained = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        trained.precompute_compress(level=LEVEL)
        made.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=False, write_checksum=False)))
    return made


def sizes(text: bytes, made: list[tuple[str, zstandard.ZstdCompressor]]) -> np.ndarray:
    """Encoded bytes of a whole text under each dictionary."""
    pieces = [text[a : a + PIECE] for a in range(0, len(text), PIECE)]
    return np.array([sum(len(c.compress(p)) for p in pieces) for _, c in made], np.int64)


def predict(docs: DataFrame, content: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Input columns + _lang_pred, _score, _margin, _rejected (columns of these names are replaced). Only the text is an input of the prediction.

    The label with the smallest encoding wins, a tie goes to the first by name. score is
    1 / (1 + 2 ** -(bits won per hundred bytes)), from a half for a tie to 1; margin is (second - best) / second, 1 with a single label.
    Null texts and texts without a letter are `und` with score 0 and rejected, as are all where no label was learned.
    """
    struct = "struct<lang:string, score:double, margin:double>"
    made: list[list[tuple[str, zstandard.ZstdCompressor]]] = []

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not made:
            made.append(encoders(content))
        for texts in batches:
            langs, scores, margins = [], [], []
            for t in texts:
                t = t.as_py()
                if t is None or not made[0]:
                    langs.append(UND), scores.append(0.0), margins.append(0.0)
                    continue
                n = sizes(t, made[0])
                order = np.argsort(n, kind="stable")
                best, second = n[order[0]], n[order[1]] if len(n) > 1 else 2 * n[order[0]]
                langs.append(made[0][order[0]][0])
                margins.append(float(second - best) / float(second))
                scores.append(1.0 / (1.0 + 2.0 ** -min(60.0, 800.0 * float(second - best) / max(len(t), 1))))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())], ["lang", "score", "margin"])

    judge = F.arrow_udf(run, struct)
    judged = docs.withColumn("_judged", judge(letters(F.col(text_col))))
    margin = F.col("_judged.margin")
    return judged.withColumns(
        {"_lang_pred": F.col("_judged.lang"), "_score": F.col("_judged.score"), "_margin": margin, "_rejected": (F.col("_judged.lang") == UND) | (margin < MARGIN)}
    ).drop("_judged")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """predict() with dictionaries learned from the labelled rows whose crc32(id as text) mod 4 is not 2 (null id: as empty)."""
    return predict(docs, sample(docs, id_col, text_col, lang_col), id_col, text_col)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that are not rejected, columns unchanged, whatever their names."""
    rows, names = apart(docs, id_col, text_col, lang_col)
    return identify(rows, *names).filter(~F.col("_rejected")).select(*rows.columns).toDF(*docs.columns)
