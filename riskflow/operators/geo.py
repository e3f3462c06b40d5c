"""Nearest known place of a point, exact, by Euclidean distance in degrees; ties go to the first city name.

Points are not paired with places. The globe is cut into cells, finer where places are dense, and for each cell the few
places are listed that can be nearest to some point in it. A point finds its cell in a directory and reads its list.

Cells and places are refined together. Places are grouped by the cells of a grid of their own, each group with its bounds,
its size and one place of it. A cell starts with a few coarse groups. A group is left out if all of it is farther off than
some place must be, or if one place is nearer to all four corners of the cell than any place of the group can be, and so
to all of the cell. A cell with few groups has its groups cut into finer ones, down to single places; a cell with many
is cut itself, and its parts inherit the groups. It ends with at most MAX_LISTED single places, or at a level where cells
are smaller than rounding allows to tell apart. Work on places grows with their number, not with that of the points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from riskflow.operators.skew import heavy_keys, lookup
from riskflow.sources.storage import stored

# Level l has 2^l x 2^l cells. Cells begin at the first level, and are cut by STEP levels at a time.
FIRST_LEVEL, STEP, LAST_LEVEL = 4, 2, 24
# A cell with more listed places than this is cut further; a cell with more groups than that is cut before its groups are.
MAX_LISTED = 8
MAX_GROUPS = 12
# Levels between two stages of the directory.
STAGE = 4
# Bounds are compared with slack for rounding, in proportion and beyond; a place listed without need does no harm.
SLACK, LEAST_SLACK = 1e-9, 1e-12


def _row(lat: str, level: int | str) -> str:
    return f"least(floor(({lat} + 90) * shiftleft(1L, {level}) / 180D), shiftleft(1L, {level}) - 1)"


def _col(lon: str, level: int | str) -> str:
    return f"least(floor(({lon} + 180) * shiftleft(1L, {level}) / 360D), shiftleft(1L, {level}) - 1)"


def _on_globe(lat: str, lon: str) -> str:
    return f"{lat} between -90D and 90D and {lon} between -180D and 180D"


def _within(smallest: str, bound: str) -> str:
    return f"{smallest} <= {bound} * {1 + SLACK}D + {LEAST_SLACK}D"


CORNERS = {"sw": ("south", "west"), "se": ("south", "east"), "nw": ("north", "west"), "ne": ("north", "east")}
RIVALS = [*CORNERS, "middle"]
GROUP = ["group_level", "gx", "gy", "south_most", "west_most", "north_most", "east_most", "places", "lat", "lon", "city"]


def _group_tree(places: DataFrame) -> DataFrame:
    """The parts of each group: (level, px, py) and the columns of a finer group in it.

    A group of at most MAX_LISTED places, or of the last level, has its single places as parts.
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(LAST_LEVEL), F.lit(STEP))).alias("level")
    rows = places.select("*", levels).selectExpr("*", f"{_col('lon', 'level')} as px", f"{_row('lat', 'level')} as py")
    small = F.expr(f"n <= {MAX_LISTED} or level = {LAST_LEVEL}").alias("small")
    sizes = rows.groupBy("level", "px", "py").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("level", "px", "py", small)
    rows = rows.join(sizes, ["level", "px", "py"]).selectExpr(
        "*", f"level + {STEP} as group_level", f"{_col('lon', f'(level + {STEP})')} as gx", f"{_row('lat', f'(level + {STEP})')} as gy"
    )
    alone = lambda c: f"if(small, {c}, 0D) as alone_{c}"
    return (
        rows.selectExpr("*", alone("lat"), alone("lon"))
        .groupBy("level", "px", "py", "group_level", "gx", "gy", "alone_lat", "alone_lon")
        .agg(
            F.min("lat").alias("south_most"), F.min("lon").alias("west_most"), F.max("lat").alias("north_most"), F.max("lon").alias("east_most"),
            F.count(F.lit(1)).alias("places"), F.min(F.struct("lat", "lon", "city")).alias("one"),
        )
        .select("level", "px", "py", *GROUP[:-3], "one.*")
    )


def _with_distances(rows: DataFrame) -> DataFrame:
    """Add squared distances: from the corners of the cell to the group's place and to the group's bounds (`lo_`), from
    the middle to the place, from the cell to the bounds, and from the cell's farthest corner to the place."""
    gap = lambda y, x: (
        f"pow(greatest(south_most - {y}, {y} - north_most, 0D), 2) + pow(greatest(west_most - {x}, {x} - east_most, 0D), 2)"
    )
    return (
        rows.selectExpr("*", "180D / shiftleft(1L, level) as height", "360D / shiftleft(1L, level) as width")
        .selectExpr("*", "iy * height - 90D as south", "ix * width - 180D as west")
        .selectExpr("*", "south + height as north", "west + width as east")
        .selectExpr(
            "*",
            *[f"pow({y} - lat, 2) + pow({x} - lon, 2) as {c}" for c, (y, x) in CORNERS.items()],
            *[f"{gap(y, x)} as lo_{c}" for c, (y, x) in CORNERS.items()],
            "pow((south + north) / 2 - lat, 2) + pow((west + east) / 2 - lon, 2) as middle",
            "pow(greatest(south_most - north, south - north_most, 0D), 2) + pow(greatest(west_most - east, west - east_most, 0D), 2) as smallest",
        )
        .selectExpr("*", "greatest(sw, se, nw, ne) as largest")
        .drop("height", "width", "south", "west", "north", "east")
    )


def _weighed(rows: DataFrame, max_listed: int) -> DataFrame:
    """Drop groups that hold no nearest place of any point of their cell, and tell what to do with the cell.

    The rivals of a group are the places nearest to each corner and to the middle of the cell.
    """
    cell = "over (partition by level, ix, iy)"
    # The bound of the cell that was cut holds for its parts too, so most rows go before the shuffle.
    near = _with_distances(rows).filter(_within("smallest", "bound")).drop("bound")
    beaten = [" and ".join(f"not ({_within(f'lo_{c}', f'{rival}_rival.{c}')})" for c in CORNERS) for rival in RIVALS]
    return (
        near.selectExpr(
            "*", f"min(largest) {cell} as bound", *[f"min(struct({rival} as d, {', '.join(CORNERS)})) {cell} as {rival}_rival" for rival in RIVALS]
        )
        .filter(_within("smallest", "bound"))
        .filter(f"not ({' or '.join(f'({b})' for b in beaten)})")
        .selectExpr("level", "ix", "iy", "bound", *GROUP, f"count(1) {cell} as listed", f"max(places) {cell} as most")
        .selectExpr(
            "*",
            f"""case when most = 1 and (listed <= {max_listed} or level >= {LAST_LEVEL}) then 'done'
              when most > 1 and (listed <= {MAX_GROUPS} or level >= {LAST_LEVEL}) then 'cut groups' else 'cut cell' end as action""",
        )
        .drop("listed", "most")
    )


def _refined(rows: DataFrame, tree: DataFrame) -> DataFrame:
    """The next rows of the cells that are not done."""
    cell = ["level", "ix", "iy", "bound"]
    grouped = rows.filter("action = 'cut groups'")
    parts = tree.select(F.col("level").alias("group_level"), F.col("px").alias("gx"), F.col("py").alias("gy"), F.struct(*GROUP).alias("part"))
    finer = grouped.filter("places > 1").select(*cell, "group_level", "gx", "gy").join(parts, ["group_level", "gx", "gy"]).select(*cell, "part.*")
    side = 1 << STEP
    cut = (
        rows.filter("action = 'cut cell'")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(side * side - 1))))
        .selectExpr(f"level + {STEP} as level", f"ix * {side} + part % {side} as ix", f"iy * {side} + part div {side} as iy", "bound", *GROUP)
    )
    return grouped.filter("places = 1").select(*cell, *GROUP).unionByName(finer).unionByName(cut)


def place_cells(places: DataFrame, max_listed: int = MAX_LISTED, work_dir: str | None = None) -> DataFrame:
    """Cells that cover the globe without overlap: level, ix, iy and the listed places as `near`.

    `places` has city, lat and lon; of those at one spot the first city stays, and those without a city or off the globe are
    left out. The result is stored; it
    depends on places only, so it can be used again. `max_listed` is at least 4, as three
    places or more share a corner between them, however small the cell.
    """
    if max_listed < 4:
        raise ValueError("cells whose lists are shorter than 4 cannot cover the globe")
    places = stored(
        places.filter(f"city is not null and {_on_globe('lat', 'lon')}")
        .groupBy(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
        .agg(F.min("city").alias("city")),
        work_dir,
    )
    tree = stored(_group_tree(places), work_dir)
    # With one place there is no group to cut; else these are the parts of the whole globe, 16 at most.
    coarse = tree.filter("level = 0").select(*GROUP)
    single = places.selectExpr(f"{STEP} as group_level", "0L as gx", "0L as gy", "lat", "lon", "lat", "lon", "1L as places", "lat", "lon", "city").toDF(*GROUP)
    coarse = coarse if places.take(2)[1:] else single
    side = 1 << FIRST_LEVEL
    rows = coarse.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(side * side - 1)))).selectExpr(
        f"{FIRST_LEVEL} as level", f"cast(cell % {side} as long) as ix", f"cast(cell div {side} as long) as iy", "double('infinity') as bound", *GROUP
    )
    done = []
    while True:
        weighed = stored(_weighed(rows, max_listed), work_dir)
        done.append(weighed.filter("action = 'done'"))
        if weighed.filter("action <> 'done'").isEmpty():
            break
        rows = _refined(weighed, tree)
    lists = reduce(DataFrame.unionByName, done)
    return stored(lists.groupBy("level", "ix", "iy").agg(F.expr("collect_list(struct(lat, lon, city)) as near")), work_dir)


def _directory(cells: DataFrame) -> DataFrame:
    """(stage, _node, _levels): for each cell of level `stage` that is cut, the level of the list's cell at each spot of the
    level STAGE finer, 0 where it is finer still. The size is in proportion to the places."""
    inner = 1 << STAGE
    stages = F.explode(F.sequence(F.lit(FIRST_LEVEL), F.col("level") - 1, F.lit(STAGE))).alias("stage")
    spots = (
        cells.filter(f"level > {FIRST_LEVEL}")
        .select("level", "ix", "iy", stages)
        .selectExpr("*", f"greatest(level - stage - {STAGE}, 0) as deeper", f"greatest(stage + {STAGE} - level, 0) as above")
        .selectExpr(
            "stage", "if(deeper > 0, 0, level) as level", "shiftleft(1, above) as wide",
            "shiftright(ix, deeper) * shiftleft(1L, above) as sx", "shiftright(iy, deeper) * shiftleft(1L, above) as sy",
        )
        .distinct()
        .selectExpr("*", "explode(sequence(0, wide * wide - 1)) as spot")
        .selectExpr("stage", "level", "sx + spot % wide as sx", "sy + spot div wide as sy")
    )
    return (
        spots.selectExpr(
            "stage", "level", f"{_cell_id('stage', f'(sx div {inner})', f'(sy div {inner})')} as _node", f"sy % {inner} * {inner} + sx % {inner} as spot"
        )
        .groupBy("stage", "_node")
        .agg(F.expr("sort_array(collect_list(struct(spot, cast(level as tinyint) as level))).level as _levels"))
    )


def _cell_id(level: str, ix: str, iy: str) -> str:
    return f"(({level} * {1 << 24}L + {iy}) * {1 << 24}L + {ix})"


def _with_cell(points: DataFrame, directory: DataFrame, deepest: int, lat: str, lon: str) -> DataFrame:
    """Add the id of the cell that holds the point, null off the globe. `deepest` is the finest level of a cell."""
    inner = 1 << STAGE
    out = points.withColumn("_level", F.expr(f"if({_on_globe(lat, lon)}, 0, null)"))  # 0: not known yet
    for stage in range(FIRST_LEVEL, max(deepest, FIRST_LEVEL + 1), STAGE):
        spot = f"{_row(lat, stage + STAGE)} % {inner} * {inner} + {_col(lon, stage + STAGE)} % {inner}"
        node = f"if(_level = 0, {_cell_id(str(stage), _col(lon, stage), _row(lat, stage))}, null)"
        out = (
            out.withColumn("_node", F.expr(node))
            .join(directory.filter(f"stage = {stage}").select("_node", "_levels"), "_node", "left")
            # A cell that is not in the directory is not cut.
            .withColumn("_level", F.expr(f"if(_level = 0, coalesce(_levels[cast({spot} as int)], {stage}), _level)"))
            .drop("_node", "_levels")
        )
    return out.withColumn("_cell", F.expr(_cell_id("_level", _col(lon, "_level"), _row(lat, "_level")))).drop("_level")


def add_city_features(
    df: DataFrame,
    cells: DataFrame,
    lat_col: str = "shipment_location_lat",
    long_col: str = "shipment_location_long",
    keys_from: DataFrame | None = None,
    work_dir: str | None = None,
) -> DataFrame:
    """Add the city of the nearest place. `cells` comes from `place_cells`.

    The city is null where a coordinate is missing or not on the globe. Skew is measured on `keys_from` (default
    `df`), which needs the two coordinate columns.
    """
    missing = {lat_col, long_col} - set(df.columns)
    if missing:
        raise ValueError(f"missing coordinate columns: {sorted(missing)}")
    directory = stored(_directory(cells), work_dir)
    deepest = cells.agg(F.max("level")).first()[0] or FIRST_LEVEL
    base = (df if keys_from is None else keys_from).select(lat_col, long_col)
    heavy = heavy_keys(_with_cell(base, directory, deepest, lat_col, long_col), "_cell")
    lists = cells.selectExpr(f"{_cell_id('level', 'ix', 'iy')} as _cell", "near as _near")
    dy, dx = f"({lat_col} - p.lat)", f"({long_col} - p.lon)"
    nearest = f"array_min(transform(_near, p -> struct({dy} * {dy} + {dx} * {dx} as d, p.city as city))).city"
    located = lookup(_with_cell(df, directory, deepest, lat_col, long_col), lists, "_cell", heavy["_cell"], "left")
    return located.withColumn("city", F.expr(nearest)).drop("_cell", "_near")


def nearest_place(
    points: DataFrame, places: DataFrame, lat_col: str = "lat", long_col: str = "lon"
) -> DataFrame:
    return add_city_features(points, place_cells(places), lat_col, long_col)
