"""Image columns: candidates, item codes and first use on a page."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

INLINE_PREFIX = "data:image"
# Fixed value: an item code inside an image address.
CODE_PATTERN = r"MLA\p{Nd}+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` loops over it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_inline_image(src: Column) -> Column:
    return src.startswith(INLINE_PREFIX)


def image_candidate(data_src: Column, src: Column) -> Column:
    """The lazy-load source when there is one, else a source that is not inline data."""
    return F.coalesce(
        F.nullif(data_src, F.lit("")),
        F.when(~is_inline_image(src), F.nullif(src, F.lit(""))),
    )


def has_code(image: Column) -> Column:
    return image.rlike(CODE_PATTERN)


def product_code(image: Column) -> Column:
    return F.nullif(F.regexp_extract(image, CODE_PATTERN, 0), F.lit(""))


def images_array(image: Column) -> Column:
    return F.array(image)


def first_image(images: Column) -> Column:
    return F.get(images, F.lit(0))


def first_uses(candidates: Column) -> Column:
    """Keep each image at its first place in the array; later uses become NULL.

    Sorting brings equal images together with the first place in front, and a second sort
    restores the order, so a long page costs no more than its sort.
    """
    placed = F.array_sort(F.transform(candidates, lambda c, i: F.struct(c.alias("c"), i.alias("i"))))
    marked = let(
        placed,
        lambda sorted_: F.transform(
            sorted_,
            lambda x, j: F.struct(
                x["i"].alias("i"),
                F.when(~x["c"].eqNullSafe(F.get(sorted_, j - 1)["c"]), x["c"]).alias("c"),
            ),
        ),
    )
    return F.transform(F.array_sort(marked), lambda x: x["c"])
