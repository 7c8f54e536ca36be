"""From address text to the address table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitescore.functions.text import normalise_address, parse_address
from sitescore.operators.balance import balanced_join
from sitescore.operators.similar import similar_pairs
from sitescore.session import spread

MAX_EDITS = 2
# What the match rests on.
EXACT, SPELLING = "exact", "spelling"
INTERPOLATED, STREET, POSTCODE = "interpolated", "street", "postcode"


def _best(frame: DataFrame, keys: list[str], first: str) -> DataFrame:
    """Smallest ``first`` per key with its columns; combined before the shuffle."""
    rest = [c for c in frame.columns if c not in keys and c != first]
    picked = frame.groupBy(*keys).agg(F.min(F.struct(first, *rest)).alias("__best"))
    return picked.select(*keys, "__best.*")


def geocode(
    df: DataFrame,
    fabric: DataFrame,
    address: str = "address",
    block: str | None = "zipcode",
    fuzzy: bool = False,
    max_edits: int = MAX_EDITS,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Add ``geocode_result`` (addr_id, x, y, formatted_address, precision, error).

    Lines are normalised on both sides and matched exactly, together with the
    ``block`` column if one is given. With ``fuzzy`` the rest takes the nearest
    spelling within ``max_edits`` in the same block. Among several addresses the
    nearest and then the smallest id wins. Rows without a match are dropped
    unless ``keep_unmatched``.
    """
    keys = ["__line", "__block"]

    def blocked(frame: DataFrame, text: str) -> DataFrame:
        part = F.lit("") if block is None else F.col(block).cast("string")
        return frame.withColumns({"__line": normalise_address(F.col(text)), "__block": part})

    asked = blocked(df, address)
    # One row per different question and per different address: repeated lines
    # are matched once, however many rows share them.
    questions = asked.select(*keys).where(F.col("__line").isNotNull() & F.col("__block").isNotNull()).distinct()
    known = blocked(fabric, "address_line").where(F.col("__line").isNotNull())
    known = _best(known.select(*keys, "addr_id", F.col("lon").alias("x"), F.col("lat").alias("y"), "address_line"), keys, "addr_id")
    known = known.withColumnRenamed("address_line", "formatted_address")
    fields = ["addr_id", "x", "y", "formatted_address"]

    answers = questions.join(known, on=keys).select(*keys, *fields, F.lit(EXACT).alias("precision"))
    if fuzzy:
        open_questions = questions.join(known.select(*keys), on=keys, how="left_anti")

        # Spellings differ in length by the edits at most: other addresses are not cut into segments.
        size = F.length("__line")
        sizes = F.explode(F.sequence(size - max_edits, size + max_edits)).alias("__size")
        in_reach = open_questions.select("__block", sizes).distinct()
        possible = known.withColumn("__size", size).join(in_reach, on=["__block", "__size"], how="left_semi")

        # Only what the comparison needs goes through the join.
        near = similar_pairs(
            spread(open_questions.withColumnRenamed("__line", "__asked"), "__asked", "__block"),
            spread(possible.select(F.col("__line").alias("__known"), "__block", "addr_id"), "__known", "__block"),
            ["__block"],
            "__asked",
            "__known",
            max_edits,
        ).select("__asked", "__block", "__edits", "addr_id", "__known")
        nearest = _best(near, ["__asked", "__block"], "__edits").select("__asked", "__block", F.col("__known").alias("__line"))
        spelled = nearest.join(known, on=keys).select(F.col("__asked").alias("__line"), "__block", *fields, F.lit(SPELLING).alias("precision"))
        answers = answers.unionByName(spelled)

    joined = balanced_join(asked, answers, keys, how="left", right_unique=True).drop(*keys)
    error = F.when(F.col("addr_id").isNull(), F.lit("no match"))
    result = F.struct(*fields, "precision", error.alias("error")).alias("geocode_result")
    if not keep_unmatched:
        joined = joined.where(F.col("addr_id").isNotNull())
    return joined.select(*df.columns, result)


def geocode_parsed(
    df: DataFrame,
    fabric: DataFrame,
    address: str = "address",
    block: str = "zipcode",
    max_edits: int = MAX_EDITS,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Add ``geocode_result`` as :func:`geocode` does, from number, street and unit told apart.

    The house number is never changed. ``precision`` names the tier, best first:
    ``exact``: number and street are known in the block, with the unit if that is
    known too, else the smallest id at that number; ``spelling``: the same on the
    nearest street of the block within ``max_edits``, if the street itself is
    unknown there, ties by name; ``interpolated``: the number lies between two
    known numbers of that street, the place is on the line between them;
    ``street``: it lies beyond the known numbers, the place is that of the nearest;
    ``postcode``: the street is not known, the place is the mean of the block's
    addresses. From ``interpolated`` on there is no ``addr_id`` and no
    ``formatted_address``. Lines without a number get a place in their street's
    block only (``postcode``). NULL lines and unknown blocks are ``no match``.
    """
    place = ["number", "street", "unit"]

    def parsed(frame: DataFrame, text: str) -> DataFrame:
        line = parse_address(F.col(text))
        return frame.withColumns({"__block": F.col(block).cast("string"), **{f"__{p}": line[p] for p in place}})

    keys = ["__block", "__number", "__street", "__unit"]
    asked = parsed(df, address).withColumn("__asks", F.col(address).isNotNull() & (F.trim(address) != ""))
    questions = asked.where("__asks").select(*keys).where(F.col("__block").isNotNull()).distinct()
    known = parsed(fabric, "address_line").where("__block IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL")
    known = known.select(*keys, "addr_id", F.col("lon").alias("x"), F.col("lat").alias("y"), F.col("address_line").alias("formatted_address"))
    housed = known.where("__number IS NOT NULL AND __street IS NOT NULL")

    # which street of the block is meant: few streets, however many addresses
    streets = housed.select("__block", F.col("__street").alias("__meant")).distinct()
    wanted = questions.where("__number IS NOT NULL AND __street IS NOT NULL").select("__block", "__street").distinct()
    same = wanted.join(streets.withColumn("__street", F.col("__meant")), on=["__block", "__street"]).withColumn("__edits", F.lit(0))
    other = wanted.join(same, on=["__block", "__street"], how="left_anti")
    near = similar_pairs(other, streets, ["__block"], "__street", "__meant", max_edits)
    nearest = near.groupBy("__block", "__street").agg(F.min(F.struct("__edits", "__meant")).alias("best"))
    nearest = nearest.select("__block", "__street", "best.__meant", "best.__edits")
    meant = questions.join(same.select(*nearest.columns).unionByName(nearest), on=["__block", "__street"]).where("__number IS NOT NULL")

    # one row for each known house number, and the best row for a unit
    of_house = ["__block", "__meant", "__number"]
    fields = F.struct("addr_id", "x", "y", "formatted_address")
    housed = housed.withColumnRenamed("__street", "__meant")
    houses = housed.groupBy(*of_house).agg(F.min(fields).alias("house"))
    units = housed.where("__unit IS NOT NULL").groupBy(*of_house, "__unit").agg(F.min(fields).alias("flat"))
    plain = housed.where("__unit IS NULL").groupBy(*of_house).agg(F.min(fields).alias("bare"))

    # the known numbers next to each asked one, along the street
    along = houses.select(*of_house, F.col("house"), F.lit(True).alias("known"))
    along = along.unionByName(meant.select(*of_house).distinct().withColumn("known", F.lit(False)), allowMissingColumns=True)
    street = Window.partitionBy("__block", "__meant").orderBy("__number", F.col("known").desc())
    mark = F.when(F.col("known"), F.struct("__number", "house"))
    before = F.last(mark, ignorenulls=True).over(street.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first(mark, ignorenulls=True).over(street.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    seen = along.select(*of_house, "known", before.alias("low"), after.alias("high")).where("not known").drop("known")

    found = meant.join(seen, on=of_house).join(units, on=[*of_house, "__unit"], how="left").join(plain, on=of_house, how="left")
    at_house = F.when(F.col("low.__number") == F.col("__number"), F.coalesce("flat", F.when(F.col("__unit").isNull(), F.col("bare")), "low.house"))
    share = (F.col("__number") - F.col("low.__number")) / (F.col("high.__number") - F.col("low.__number"))

    def on_way(c: str) -> Column:
        low, high = F.col(f"low.house.{c}"), F.col(f"high.house.{c}")
        return F.when(F.col("low").isNull(), high).when(F.col("high").isNull(), low).otherwise(low + share * (high - low))

    between = F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), INTERPOLATED).otherwise(STREET)
    none = {n: F.lit(None).cast(t) for n, t in known.select("addr_id", "formatted_address").dtypes}
    answers = found.withColumn("hit", at_house).select(
        *keys,
        F.col("hit.addr_id").alias("addr_id"),
        F.when(F.col("hit").isNotNull(), F.col("hit.x")).otherwise(on_way("x")).alias("x"),
        F.when(F.col("hit").isNotNull(), F.col("hit.y")).otherwise(on_way("y")).alias("y"),
        F.col("hit.formatted_address").alias("formatted_address"),
        F.when(F.col("hit").isNull(), between).when(F.col("__edits") > 0, SPELLING).otherwise(EXACT).alias("precision"),
    )
    centres = known.groupBy("__block").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    match = [F.col(f"q.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]
    left = questions.alias("q").join(answers.alias("a"), on=match, how="left_anti")
    rest = left.join(centres, on="__block").select(*keys, none["addr_id"].alias("addr_id"), "x", "y", none["formatted_address"].alias("formatted_address"), F.lit(POSTCODE).alias("precision"))
    # a key that may be NULL is joined as text
    name = F.to_json(F.struct(*keys)).alias("__question")
    every = answers.unionByName(rest).select(name, "addr_id", "x", "y", "formatted_address", "precision")
    asked = asked.withColumn("__question", F.when(F.col("__asks"), F.to_json(F.struct(*keys)))).drop(*keys, "__asks")
    joined = balanced_join(asked, every, "__question", how="left", right_unique=True).drop("__question")
    error = F.when(F.col("precision").isNull(), F.lit("no match"))
    result = F.struct("addr_id", "x", "y", "formatted_address", "precision", error.alias("error")).alias("geocode_result")
    if not keep_unmatched:
        joined = joined.where(F.col("precision").isNotNull())
    return joined.select(*df.columns, result)
