"""Feature building: text encoder, one-hot object features, modality
assembly with zero fill, width fitting, fallback chain, alignment."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Normalizer, OneHotEncoder, RegexTokenizer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mise.functions.columns import clean_text, fit_width, has_modality, zero_fill, zero_vector
from mise.operators.labels import encode_labels
from mise.schema import TEXT_DIM

MODE_LETTERS = {"t": "text", "o": "object", "v": "visual"}
MODE_NAMES = {"text": "t", "object": "o", "fusion": "to", "video": "v", "visual": "v"}
STREAM_ORDER = ("t", "o", "v")
EMPTY_SALT = 64


def mode_streams(mode: str) -> list[str]:
    """Mode name or letters to the ordered stream letters (text, object,
    visual order, whatever order the letters were given in)."""
    letters = MODE_NAMES.get(mode, mode)
    bad = set(letters) - set(STREAM_ORDER)
    if bad or not letters:
        raise ValueError(f"unknown mode {mode!r}")
    return [s for s in STREAM_ORDER if s in letters]


def assemble(mode: str, columns: dict[str, str], dims: dict[str, int], dtype: str = "float") -> Column:
    """Concatenation of the mode's streams (``array<float>`` by default); a
    missing stream (NULL) becomes zeros of its width.  ``columns`` and
    ``dims`` are keyed by stream letter."""
    return F.concat(*[zero_fill(columns[s], dims[s], dtype) for s in mode_streams(mode)])


def assemble_vectors(df: DataFrame, mode: str, columns: dict[str, str], dims: dict[str, int], out: str = "x") -> DataFrame:
    """``assemble`` for ML vectors: sparse streams stay sparse, so a row costs its non-zero
    elements and not the width of the class space.  Array streams are converted; a missing stream
    (NULL) is zeros of its width."""
    streams = mode_streams(mode)
    made = df.select("*", *[F.coalesce(_vector(df, columns[s]), array_to_vector(zero_vector(dims[s], "double"))).alias(f"_in_{s}") for s in streams])
    for s in streams:
        made = VectorSizeHint(inputCol=f"_in_{s}", size=dims[s], handleInvalid="error").transform(made)
    made = VectorAssembler(inputCols=[f"_in_{s}" for s in streams], outputCol=out).transform(made)
    return made.drop(*[f"_in_{s}" for s in streams])


def _vector(df: DataFrame, col: str) -> Column:
    return F.col(col) if isinstance(df.schema[col].dataType, VectorUDT) else F.when(F.col(col).isNotNull(), array_to_vector(F.col(col)))


def fallback_vectors(primary: Column, secondary, dim: int) -> Column:
    """``fallback_features`` with a (sparse) ML vector as primary and result."""
    sec = F.col(secondary) if isinstance(secondary, str) else secondary
    return F.coalesce(primary, array_to_vector(F.coalesce(F.when(sec.isNotNull(), fit_width(sec, dim, "double")), zero_vector(dim, "double"))))


def fallback_features(primary: Column, secondary, dim: int, dtype: str = "float") -> Column:
    """Per row: the primary vector when present, else the secondary vector
    fitted to ``dim``, else zeros."""
    sec = F.col(secondary) if isinstance(secondary, str) else secondary
    return F.coalesce(primary.cast(f"array<{dtype}>"),
                      F.when(sec.isNotNull(), fit_width(sec, dim, dtype)),
                      zero_vector(dim, dtype))


def encode_text(df: DataFrame, text: str, out: str = "text_vec", dim: int = TEXT_DIM,
                factory=None, as_vector: bool = False) -> DataFrame:
    """Text encoder over whole texts.  Adds ``out`` and ``{out}_tokens``.

    Built in (``factory=None``): whitespace tokens, hashed term counts of
    width ``dim``, L2-normalised -- JVM-side (MLlib transformers), row by row:
    hashing a text costs less than shuffling it.  ``as_vector=True`` keeps the
    output as a sparse ML vector (for MLlib estimators).

    A plug-in encoder (a sentence model, say) is a factory returning
    ``encode(list[str]) -> ndarray (n, dim)``; it is built once per task, fed
    Arrow batches (``mapInPandas``) and sees each distinct text once: texts are
    grouped by their SHA-256 and rows are joined back on it.  Empty and NULL
    texts, which may be many, are spread over salted copies of their key.
    """
    tok = RegexTokenizer(inputCol="_t", outputCol="_tok", pattern=r"\s+", gaps=True, toLowercase=True)
    if factory is None:
        tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim)
        norm = Normalizer(inputCol="_tf", outputCol="_n", p=2.0)
        enc = norm.transform(tf.transform(tok.transform(df.withColumn("_t", clean_text(text)))))
        vec = F.col("_n") if as_vector else vector_to_array("_n", "float32")
        return enc.select(*df.columns, F.size("_tok").alias(f"{out}_tokens"), vec.alias(out))
    from mise.session import ship_library
    ship_library(df.sparkSession)
    empties = [f"empty-{i}" for i in range(EMPTY_SALT)]
    salted = F.concat(F.lit("empty-"), F.floor(F.rand(1) * EMPTY_SALT).cast("string"))
    keyed = df.withColumn("_h", F.when(clean_text(text) == "", salted).otherwise(F.sha2(clean_text(text), 256)))
    distinct = (df.select(clean_text(text).alias("_t")).groupBy(F.sha2("_t", 256).alias("_h")).agg(F.first("_t").alias("_t")))
    counted = tok.transform(distinct).select("_h", "_t", F.size("_tok").alias(f"{out}_tokens"))
    schema = f"_h string, {out}_tokens int, {out} array<float>, _empty boolean"

    def run(batches):
        import numpy as np
        encode = factory()
        for pdf in batches:
            if len(pdf):
                vecs = np.asarray(encode(list(pdf["_t"])), dtype=np.float32)
                yield pdf[["_h", f"{out}_tokens"]].assign(**{out: list(vecs), "_empty": (pdf["_t"] == "").to_numpy()})

    enc = counted.mapInPandas(run, schema)
    enc = enc.withColumn("_h", F.explode(F.when(F.col("_empty"), F.array(*[F.lit(e) for e in empties])).otherwise(F.array("_h"))))
    return keyed.join(enc.drop("_empty"), "_h", "left").drop("_h")


def one_hot(df: DataFrame, mapping: DataFrame, col: str, out: str = "object_vec", width: int | None = None) -> DataFrame:
    """One-hot of the class string over the mapping's classes, a sparse vector
    (width = number of classes, counted if not given); an unseen or NULL class gives the empty vector."""
    width = mapping.count() if width is None else width
    if width == 0:
        raise ValueError("the mapping has no class")
    enc = encode_labels(df, mapping, col, out="_idx")
    enc = enc.withColumn("_idx", F.when(F.col("_idx") < 0, width).otherwise(F.col("_idx")).cast("double"))
    # what lies behind the last class is kept as a class of its own, and that one is dropped
    last = df.sparkSession.createDataFrame([(float(width - 1),)], "_idx double")
    encoder = OneHotEncoder(inputCol="_idx", outputCol=out, handleInvalid="keep", dropLast=True).fit(last)
    return encoder.transform(enc).drop("_idx")


def one_hot_index(vec) -> Column:
    """Position of the hot element, -1 for an all-zero vector."""
    v = F.col(vec) if isinstance(vec, str) else vec
    return F.when(has_modality(v), F.array_position(v, F.lit(1.0).cast("float")) - 1).otherwise(F.lit(-1)).cast("long")


def align(key: str, *tables: DataFrame, how: str = "inner") -> DataFrame:
    """Tie tables about the same clips together by key (never by position)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, key, how)
    return out
