"""Similarity of two strings or token sets as columns; sequence scores by one Arrow function a batch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The sequence scores.
SCORES = ("ratio", "wratio", "partial", "token_sort", "token_set")


def _distinct(left, right):
    """Each different pair of strings of a batch once, and where each row's pair is."""
    import numpy as np

    one, two = (x.fill_null("").dictionary_encode() for x in (left, right))
    n = max(len(two.dictionary), 1)
    codes, where = np.unique(one.indices.to_numpy().astype(np.int64) * n + two.indices.to_numpy(), return_inverse=True)
    first, second = one.dictionary.to_pylist(), two.dictionary.to_pylist()
    return [first[c] for c in (codes // n).tolist()], [second[c] for c in (codes % n).tolist()], where


def scores(left: Column, right: Column, fields: tuple[str, ...] = SCORES) -> Column:
    """A struct of the sequence scores asked for; 0 where one side is empty, 1 for ratio and wratio where both are."""

    @F.arrow_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in fields]))
    def run(left, right):
        import numpy as np
        import pyarrow as pa

        from tesserae.functions import kernel

        a, b, where = _distinct(left, right)
        full = np.array([bool(x) and bool(y) for x, y in zip(a, b)], dtype=bool)
        none = np.array([not x and not y for x, y in zip(a, b)], dtype=bool)
        make = {
            "ratio": lambda: np.where(none, 1.0, np.where(full, kernel.ratios(a, b), 0.0)),
            "wratio": lambda: np.where(none, 1.0, np.where(full, kernel.weighted(a, b), 0.0)),
            "partial": lambda: np.where(full, kernel.partial(a, b), 0.0),
            "token_sort": lambda: np.where(full, kernel.ratios(kernel.sorted_tokens(a), kernel.sorted_tokens(b)), 0.0),
            "token_set": lambda: np.where(full, kernel.token_set(a, b), 0.0),
        }
        return pa.StructArray.from_arrays([pa.array(make[f]()[where]) for f in fields], names=list(fields))

    return run(left, right)


@F.arrow_udf(T.DoubleType())
def token_sort_score(left, right):
    import numpy as np
    import pyarrow as pa

    from tesserae.functions import kernel

    a, b, where = _distinct(left, right)
    full = np.array([bool(x) and bool(y) for x, y in zip(a, b)], dtype=bool)
    return pa.array(np.where(full, kernel.ratios(kernel.sorted_tokens(a), kernel.sorted_tokens(b)), 0.0)[where])


#: Elements up to which single look-ups are faster than the sets that an intersection builds (measured).
FEW = (4, 12)


def shared(a: Column, b: Column) -> Column:
    """How many elements two arrays without repeats have in common: element by element in short ones, by intersection in others."""
    one = lambda i: F.coalesce(F.array_contains(b, F.get(a, F.lit(i))).cast("int"), F.lit(0))
    few = [(F.size(a) <= n, sum((one(i) for i in range(1, n)), one(0))) for n in FEW]
    return F.when(~F.arrays_overlap(a, b), 0).when(*few[0]).when(*few[1]).otherwise(F.size(F.array_intersect(a, b)))


def jaccard(a: Column, b: Column, both: Column | None = None) -> Column:
    """Of two arrays as sets: 1 if both are empty, 0 if one is. `both` may give what arrays without repeats share."""
    union = F.size(F.array_union(a, b)) if both is None else F.size(a) + F.size(b) - both
    both = F.size(F.array_intersect(a, b)) if both is None else both
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / F.greatest(union, F.lit(1)))


def containment(a: Column, b: Column, both: Column | None = None) -> Column:
    n, both = (F.size(F.array_distinct(a)), F.size(F.array_intersect(a, b))) if both is None else (F.size(a), both)
    return F.when(F.size(a) == 0, 1.0).otherwise(both / F.greatest(n, F.lit(1)))


def overlap(a: Column, b: Column, both: Column | None = None) -> Column:
    least = F.least(*[F.size(F.array_distinct(c) if both is None else c) for c in (a, b)])
    both = F.size(F.array_intersect(a, b)) if both is None else both
    return F.when(least == 0, 0.0).otherwise(both / F.greatest(least, F.lit(1)))


def common(a: Column, b: Column, both: Column | None = None) -> Column:
    return F.size(F.array_intersect(a, b)) if both is None else both


def length_difference(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))
