"""Document fingerprints by winnowing: hashes of k-grams, the least of every window, with their positions.

All of it is built-in functions. A text is read as UTF-8 bytes in blocks, so that what is held besides
the text follows the block, not the text. A k-gram is hashed at every byte. Expressions carry no state
from one place to the next, so each hash is taken of its k bytes anew and not rolled on from the one before.

The least hash of each window of WINDOW k-grams is kept, the rightmost of equal ones, with its position. So any string
of GUARANTEE bytes that two texts share gives both at least one fingerprint in common, and a
string shorter than GRAM bytes never does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import filled
from tripweave.operators.slices import DRAW, SLICE, all_columns, in_order, sliced

GRAM = 16
WINDOW = 32
GUARANTEE = GRAM + WINDOW - 1
#: Windows that are looked at together. Places in a block take PLACE_BITS.
BLOCK = 4096
PLACE_BITS = 13
HASH_BITS = 32
#: The bits of a 64-bit hash that are compared: HASH_BITS of them above those of the place.
COMPARED = ((1 << HASH_BITS) - 1) << PLACE_BITS


def _nothing() -> Column:
    return F.array().cast("array<bigint>")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _least_of_windows(hashes: Column) -> Column:
    """The least of every WINDOW values in a row, or of all where there are fewer, by widening four or two times at once."""

    def wider(least: Column, width: int) -> Column:
        if width == WINDOW:
            return F.slice(least, F.lit(1), F.greatest(F.lit(1), F.size(least) - (WINDOW - 1)))
        times = 4 if WINDOW // width >= 4 else 2
        # Past the end there is nothing, which least() passes over.
        wide = F.transform(least, lambda v, i: F.least(v, *[F.get(least, i + width * k) for k in range(1, times)]))
        return _let(wide, lambda wide: wider(wide, times * width))

    return wider(hashes, 1)


def _block_picks(block: Column, start: Column) -> Column:
    """Picks of the windows that start in a block: the position in the text above HASH_BITS, the hash below.

    A hash has its place subtracted, so that of equal hashes the rightmost is least.
    """
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(block) - (GRAM - 1)))
    hashes = F.transform(places, lambda i: F.xxhash64(F.substring(block, i, F.lit(GRAM))).bitwiseAND(F.lit(COMPARED)) - i)

    def pick(v: Column) -> Column:
        # The place lies in 1 .. 2 ** PLACE_BITS - 1, so rounding up gives the hash back.
        return _let(F.shiftright(v + F.lit((1 << PLACE_BITS) - 1), PLACE_BITS), lambda h: _packed(start + F.shiftleft(h, PLACE_BITS) - v - 1, h))

    return F.transform(F.array_distinct(_let(hashes, _least_of_windows)), pick)


def _packed(position: Column, value: Column) -> Column:
    return F.shiftleft(position, HASH_BITS).bitwiseOR(value)


def _picks(data: Column) -> Column:
    """The picks of bytes, of which there is at least one."""
    windows = F.greatest(F.lit(1), F.length(data) - (GUARANTEE - 1))
    starts = F.sequence(F.lit(0), F.floor((windows - 1) / BLOCK).cast("int"))
    found = F.transform(
        starts,
        lambda b: _let(F.substring(data, b * BLOCK + 1, F.lit(BLOCK + GUARANTEE - 1)), lambda block: _block_picks(block, (b * BLOCK).cast("long"))),
    )
    return F.array_distinct(F.flatten(found))


def picks(text: Column) -> Column:
    """The kept k-grams of a text by position, none for an empty one; a text of less than GRAM bytes is one k-gram."""
    return F.when(F.length(text) == 0, _nothing()).otherwise(_let(text.cast("binary"), _picks))


def _hash_of(pick: Column) -> Column:
    return pick.bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def as_text(picked: Column) -> Column:
    """The fingerprint as text: hash and position of every pick, in order of position."""
    return F.array_join(F.transform(picked, lambda p: F.concat(F.lpad(F.hex(_hash_of(p)), HASH_BITS // 4, "0"), F.lit("@"), F.shiftright(p, HASH_BITS).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two lists of picks; two without any are alike."""

    def share(x: Column, y: Column) -> Column:
        return F.when(F.size(x) + F.size(y) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))

    return _let(F.transform(a, _hash_of), lambda x: _let(F.transform(b, _hash_of), lambda y: share(x, y)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``picks`` (position above 32 bits, hash below) and the fingerprint as text. No shuffle."""
    found = docs.select(F.col(f"`{id_col}`").alias(id_col), picks(filled(f"`{text_col}`")).alias("picks"))
    return found.withColumn("fingerprint", as_text(F.col("picks")))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, picks, next_text, next_picks): every document beside the one after it by ascending id.

    The texts are shuffled once, to even slices of their order. In a slice the next row is found by a
    window; the last row of a slice takes the first of the next slice that has rows, and the last of all the first of all.
    """
    texts = docs.select(F.col("doc_id").alias("id"), filled().alias("text")).withColumn("h", F.xxhash64("text"))
    order = ["id", "h"]
    cut = sliced(texts, order)
    here = in_order(order)
    inner = (
        cut.withColumn("picks", picks(F.col("text")))
        .withColumns({"next_text": F.lead("text").over(here), "next_picks": F.lead("picks").over(here)})
        .where(F.col("next_text").isNotNull())
        .select("id", "text", "picks", "next_text", "next_picks")
    )
    # One row per slice from here on.
    row = F.struct("id", "h", DRAW, "text")
    ends = cut.groupBy(SLICE).agg(F.min(row).alias("first"), F.max(row).alias("last"), F.count_if(all_columns(cut)).alias("rows"))
    by_slice = Window.orderBy(SLICE)
    least = F.min(SLICE).over(by_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follows = ends.where("rows > 0").select(SLICE, F.coalesce(F.lead(SLICE).over(by_slice), least).alias("after"))
    lasts = ends.select(SLICE, F.col("last.id").alias("id"), F.col("last.text").alias("text")).join(follows, SLICE)
    firsts = ends.select(F.col(SLICE).alias("after"), F.col("first.text").alias("next_text"))
    seams = lasts.join(firsts, "after")
    seams = seams.select("id", "text", picks(F.col("text")).alias("picks"), "next_text", picks(F.col("next_text")).alias("next_picks"))
    return inner.unionByName(seams)


def _moved(picked: Column, by: Column) -> Column:
    step = F.shiftleft(by.cast("long"), HASH_BITS)
    return F.transform(picked, lambda p: p + step)


def spliced_picks(text: Column, head_picks: Column, tail_picks: Column, seam: Column) -> Column:
    """Picks of a text whose first ``seam`` bytes begin one text and whose others begin another, from the picks of these two.

    A pick that ends GUARANTEE bytes or more before the end of its part is one here too, since every window
    around it lies in the part. The windows left start near the seam or near the end, and are looked at anew.
    """

    def of_bytes(data: Column) -> Column:
        size = F.length(data)

        def anew(start: Column, end: Column) -> Column:
            return _moved(_picks(F.substring(data, start + 1, end - start)), start)

        def sure(picked: Column, part: Column) -> Column:
            return F.filter(picked, lambda p: F.shiftright(p, HASH_BITS) <= part - GUARANTEE)

        near_seam = anew(F.greatest(F.lit(0), seam - 2 * GUARANTEE), F.least(size, seam + 2 * GUARANTEE))
        near_end = anew(size - 2 * GUARANTEE, size)
        parts = F.concat(sure(head_picks, seam), near_seam, _moved(sure(tail_picks, size - seam), seam), near_end)
        return F.when(size <= 8 * GUARANTEE, _picks(data)).otherwise(F.sort_array(F.array_distinct(parts)))

    return F.when(F.length(text) == 0, _nothing()).otherwise(_let(text.cast("binary"), of_bytes))


def op11_winnowing(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    A null text is empty. Null ids come first in the order, equal ids go by a hash of their text, and each row gives a
    row; rows equal in both follow each other. An only document is its own next. A text of any length is read in blocks of
    bytes; its row, with the lists of its picks, must fit a task. Other columns play no part.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("head", F.expr("left(text, int(n_chars - n_chars div 2))"))
    rows = rows.withColumn("edited", F.concat("head", F.expr("left(next_text, int(n_chars div 2))")))
    edited_picks = spliced_picks(F.col("edited"), F.col("picks"), F.col("next_picks"), F.octet_length("head"))
    rows = rows.withColumn("edited_picks", edited_picks)
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("picks")).alias("fingerprint"),
        as_text(F.col("edited_picks")).alias("edited_fingerprint"),
        likeness(F.col("picks"), F.col("edited_picks")).alias("near_edited"),
        likeness(F.col("picks"), F.col("next_picks")).alias("near_next"),
        F.size("picks").alias("n_picks"),
    )
