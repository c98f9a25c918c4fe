"""Column-level functions.

Every function here returns a ``Column`` built from Spark SQL expressions
(array higher-order functions included), so it stays inside whole-stage
codegen and needs no Python worker.  Arguments accept a column name or a
``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mise.schema import FPS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- labels and clip metadata ---------------------------------------------

def action_label(verb="verb", noun="noun") -> Column:
    """``verb + " " + noun``.  A NULL side keeps the result NULL (the
    reference printed the text ``nan`` there; we do not invent a class)."""
    return F.concat(_c(verb).cast("string"), F.lit(" "), _c(noun).cast("string"))


def duration_frames(start="start_frame", stop="stop_frame") -> Column:
    """Inclusive clip length in frames."""
    return _c(stop) - _c(start) + F.lit(1)


def elapsed_seconds(text) -> Column:
    """Elapsed-time text ``HH:MM:SS.cc`` to seconds (double).  Unparsable
    text gives NULL instead of an error."""
    parts = F.split(_c(text), ":")
    h = F.try_element_at(parts, F.lit(-3)).try_cast("double")
    m = F.try_element_at(parts, F.lit(-2)).try_cast("double")
    s = F.try_element_at(parts, F.lit(-1)).try_cast("double")
    return F.when(F.size(parts) == 3, h * 3600.0 + m * 60.0 + s)


def duration_seconds(start_text, stop_text) -> Column:
    """Clip length in seconds from the two elapsed-time texts, 2 decimals."""
    return F.round(elapsed_seconds(stop_text) - elapsed_seconds(start_text), 2)


def seconds_to_frame(seconds, fps: int = FPS) -> Column:
    """Frame number of an elapsed time: ``int(seconds * fps)`` in doubles."""
    return (_c(seconds).cast("double") * F.lit(float(fps))).cast("long")


def sample_frames(start="start_frame", stop="stop_frame", n: int = 3) -> Column:
    """``n`` frame numbers spread evenly over ``[start, stop]``.

    Same arithmetic as an evenly spaced float grid truncated to integers:
    element ``i`` is ``trunc(i * ((stop - start) / (n - 1)) + start)`` and the
    last element is exactly ``stop``.  Duplicates are kept; ``stop < start``
    gives a descending list; ``n == 1`` gives ``[start]``.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    start_c, stop_c = _c(start).cast("long"), _c(stop).cast("long")
    if n == 1:
        return F.array(start_c)
    step = (stop_c - start_c).cast("double") / F.lit(float(n - 1))
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.when(i == n - 1, stop_c).otherwise((i.cast("double") * step + start_c).cast("long")),
    )


def frame_path(video="video_id", frame_no="frame_no", root: str = "frames") -> Column:
    """``{root}/{video}/frame_{n:010d}.jpg``."""
    return F.format_string("%s/%s/frame_%010d.jpg", F.lit(root), _c(video), _c(frame_no).cast("long"))


def parse_frame_no(path) -> Column:
    """Frame number from a frame file path; NULL when the base name does not
    start with ``frame_`` or the number part is not an integer."""
    base = F.substring_index(_c(path), "/", -1)  # text after the last '/'
    rest = F.substring(base, len("frame_") + 1, 1 << 30)
    token = F.substring_index(F.substring_index(rest, "_", 1), ".", 1)  # up to the next '_' or '.'
    return F.when(base.startswith("frame_"), token.try_cast("int"))


def clean_text(col) -> Column:
    """NULL to empty text, anything else to its string form."""
    return F.coalesce(_c(col).cast("string"), F.lit(""))


# --- vectors (array<float> / array<double>) --------------------------------

def sq_norm(vec) -> Column:
    """Sum of squared elements as double."""
    return F.aggregate(_c(vec), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def l2_normalize(vec, dtype: str = "float") -> Column:
    """Vector divided by its L2 norm; a zero (or NULL) vector gives NULL."""
    norm = F.sqrt(sq_norm(vec))
    return F.when(norm > 0, F.transform(_c(vec), lambda x: (x.cast("double") / norm).cast(dtype)))


def zero_vector(dim: int, dtype: str = "float") -> Column:
    return F.array_repeat(F.lit(0.0).cast(dtype), dim)


def zero_fill(vec, dim: int, dtype: str = "float") -> Column:
    """Missing modality (NULL) to a zero vector of width ``dim``."""
    return F.coalesce(_c(vec).cast(f"array<{dtype}>"), zero_vector(dim, dtype))


def fit_width(vec, dim: int, dtype: str = "float") -> Column:
    """Truncate or zero-pad a vector to exactly ``dim`` elements."""
    return F.slice(F.concat(_c(vec).cast(f"array<{dtype}>"), zero_vector(dim, dtype)), 1, dim)


def has_modality(vec) -> Column:
    """True when the vector holds any non-zero element."""
    return F.coalesce(F.exists(_c(vec), lambda x: x != 0), F.lit(False))


def known(label) -> Column:
    """Label seen in training (``-1`` marks unseen)."""
    return _c(label) >= 0


def sparse(vec, dtype: str = "double") -> Column:
    """An ML vector as ``struct<size, indices, values>`` of its non-zero elements, whichever form
    it has; nothing as wide as the vector is made from a sparse one."""
    v = F.unwrap_udt(_c(vec))
    there = F.filter(F.sequence(F.lit(0), F.size(v["values"]) - 1), lambda i: F.get(v["values"], i) != 0)
    dense = v["type"] == 1
    return F.when(v.isNotNull(), F.struct(
        F.when(dense, F.size(v["values"])).otherwise(v["size"]).alias("size"),
        F.when(dense, there).otherwise(v["indices"]).alias("indices"),
        F.when(dense, F.filter(v["values"], lambda x: x != 0)).otherwise(v["values"]).cast(f"array<{dtype}>").alias("values")))


def first_index(parts, start: int = 0, width: int | Column | None = None) -> Column:
    """The first non-zero position of a ``sparse`` vector in a slice (counted from its start), -1 without one."""
    p = _c(parts)
    inside = F.filter(p["indices"], lambda i: (i >= start) if width is None else (i >= start) & (i < F.lit(start) + width))
    return F.coalesce(F.get(inside, F.lit(0)) - start, F.lit(-1)).cast("long")


def slice_sq_norm(parts, start: int, width: int | Column) -> Column:
    """Sum of squares of a slice of a ``sparse`` vector."""
    p = _c(parts)
    pairs = F.zip_with(p["indices"], p["values"], lambda i, x: F.when((i >= start) & (i < F.lit(start) + width), x.cast("double")).otherwise(0.0))
    return F.aggregate(pairs, F.lit(0.0).cast("double"), lambda acc, x: acc + x * x)


# --- logits ----------------------------------------------------------------

def argmax(logits) -> Column:
    """Index of the largest logit, lowest index on ties (0-based, int)."""
    z = _c(logits)
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")


def label_rank(logits, label) -> Column:
    """1-based rank of the true label among the logits: classes with a larger
    logit, or an equal logit and a lower index, come first.  No sort.  A label
    outside the logits ranks behind every class (no ``k`` reaches it); without
    logits the rank is NULL."""
    z, y = _c(logits), _c(label)
    zy = F.get(z, y)
    rank = F.size(F.filter(z, lambda x, i: (x > zy) | ((x == zy) & (i < y)))) + 1
    behind = F.lit(2**31 - 1)
    return F.when(z.isNotNull(), F.when(zy.isNull(), behind).otherwise(rank)).cast("int")


def in_top_k(logits, label, k: int) -> Column:
    """True label among the ``k`` best classes (``k`` capped by the width).
    NULL for unknown labels; a row without logits is a miss."""
    return F.when(known(label), F.coalesce(label_rank(logits, label) <= F.lit(k), F.lit(False)))


def topk_classes(logits, k: int) -> Column:
    """The ``k`` best class indices, best first, ties by lower index."""
    ranked = F.array_sort(F.transform(_c(logits), lambda x, i: F.struct((-x).alias("nx"), i.alias("i"))))
    return F.transform(F.slice(ranked, 1, k), lambda s: s["i"])


def log_sum_exp(logits) -> Column:
    """Numerically stable ``log(sum(exp(z)))``."""
    z = _c(logits)
    mx = F.array_max(z)
    return mx + F.log(F.aggregate(z, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x - mx)))


def nll(logits, label) -> Column:
    """Negative log-likelihood of the true label under softmax(logits); NULL
    for a label outside the logits."""
    return log_sum_exp(logits) - F.get(_c(logits), _c(label))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + v)
