"""Main text of web pages by differencing pages with the nearest URLs.

Pages of a host are sorted by path; each is compared with the page before and the page behind it.
Their blocks are aligned by a longest common subsequence, and shared blocks are template: menus,
notices and footers that the host repeats. Blocks that the markup puts beside the article go in any
case. Blocks inside an article or main element stay: articles of a host share sentences and whole
passages, and mirrors of a page share all. So where the marked article holds most of the text the
markup decides. Where no article is marked, or only a teaser beside more text that no markup places,
the differences decide; only blocks outside articles are compared.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.bytewords import pieces, range_hashes
from storelens.llm.frames import TEXT, field, map_texts, stored, text_column
from storelens.llm.html_blocks import MAIN, OTHER, blocks


def _lines(pages: list[bytes]) -> dict[str, list]:
    """Hashes of the blocks outside articles: only those can be template."""
    made = [blocks(p.decode("utf-8", "replace")) for p in pages]
    return {"hashes": [_hashes([t for t, z in page if z != MAIN]) for page in made]}


def _hashes(texts: list[str]) -> list[int]:
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    starts = ends - [len(r) for r in raw] if raw else ends
    return range_hashes(np.frombuffer(b"".join(raw), np.uint8), starts, ends).view(np.int64).tolist() if raw else []


def common(a: list[int], b: list[int]) -> set[int]:
    """Places in `a` of a longest common subsequence with `b`."""
    places: dict[int, list[int]] = {}
    for j, value in enumerate(b):
        places.setdefault(value, []).append(j)
    tails: list[int] = []  # least end in b of a common subsequence of each length
    links: list[tuple] = []  # its last place in a, and the chain before it
    for i, value in enumerate(a):
        for j in reversed(places.get(value, ())):
            k = bisect_left(tails, j)
            chain = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(chain)
            elif j < tails[k]:
                tails[k], links[k] = j, chain
    found, chain = set(), links[-1] if links else None
    while chain:
        found.add(chain[0])
        chain = chain[1]
    return found


def template(hashes: list[int], neighbours: list[list[int] | None]) -> list[int]:
    """Places of the blocks that a neighbour shares, among those outside articles."""
    return sorted(set().union(*(common(hashes, n) for n in neighbours if n)))


def kept(parts: list[tuple[str, int]], shared: list[int] | None) -> list[str]:
    """The blocks that are neither template nor beside the article."""
    outside = [i for i, (_, z) in enumerate(parts) if z != MAIN]
    repeated = {outside[k] for k in shared or ()}
    inside = sum(len(t) for t, z in parts if z == MAIN)
    # what the markup does not place, and no neighbour has
    unplaced = sum(len(parts[i][0]) for i in outside if parts[i][1] == OTHER and i not in repeated)
    marked = inside > 0 and inside >= unplaced
    own = {i for i, (_, z) in enumerate(parts) if z == MAIN or (z == OTHER and not marked)}
    if not marked and own <= repeated:
        repeated = set()  # a copy of its neighbour has nothing of its own to go by
    return [t for i, (t, z) in enumerate(parts) if i in own and (z == MAIN or i not in repeated)]


def neighbours(keys: DataFrame) -> DataFrame:
    """row, before, behind: the rows next to each row of `keys` (row, host, path) in its host.

    Sorted by ranges, so a host of any size is spread over tasks; the first and last row of each
    range find one another in a table with one row per range.
    """
    order = ["host", "path", "row"]
    ranges = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = ranges.withColumns({"range": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    ranges = stored(ranges, "url-order")
    inside = Window.partitionBy("range").orderBy("place")
    pair = F.struct("host", "row")
    rows = ranges.withColumns({"before": F.lag(pair).over(inside), "behind": F.lead(pair).over(inside)})
    edges = ranges.groupBy("range").agg(F.min_by(pair, "place").alias("first"), F.max_by(pair, "place").alias("last"))
    along = Window.orderBy("range")  # one row per range
    edges = edges.select("range", F.lag("last").over(along).alias("_before"), F.lead("first").over(along).alias("_behind"))
    rows = rows.join(edges, "range")
    same = lambda near, far: F.when(
        F.coalesce(near, far)["host"].eqNullSafe(F.col("host")), F.coalesce(near, far)["row"]
    )
    return rows.select(
        "row",
        same(F.col("before"), F.col("_before")).alias("before"),
        same(F.col("behind"), F.col("_behind")).alias("behind"),
    )


def extract(pages: DataFrame, keep: list[str], *, markup: str = "html", url: str = "url") -> DataFrame:
    """The columns `keep` of every page with `main_text`.

    Blocks are joined in page order by one space; a page with no such block, and a null page, gets
    an empty text. A null or odd URL has a host and path of its own kind and is compared within it.
    Repeated pages are rows of their own; no pages, no rows. A kept column may have any name; one
    named main_text gives way to the text.
    """
    carried = {f"__{i}": c for i, c in enumerate(keep) if c != "main_text"}  # no name clashes with these
    address = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    split = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)"
    # equal pages at equal addresses share a key, and all that is found of them
    rows = pages.select(
        *(F.col(f"`{c}`").alias(own) for own, c in carried.items()),
        F.xxhash64(address, text_column(pages, markup)).alias("_key"),
        F.lower(F.regexp_extract(address, split, 1)).alias("_host"),
        F.regexp_extract(address, split, 2).alias("_path"),
        text_column(pages, markup).alias(TEXT),
    )
    lines = map_texts(rows, TEXT, ["_key", "_host", "_path"], [field("hashes", "array<bigint>")], _lines)
    lines = stored(lines.dropDuplicates(["_key"]), "lines")
    near = neighbours(lines.select(F.col("_key").alias("row"), F.col("_host").alias("host"), F.col("_path").alias("path")))
    near = near.where("before is not null or behind is not null").withColumnRenamed("row", "_key")
    for column, side in (("_key", "own"), ("before", "before"), ("behind", "behind")):
        other = lines.select(F.col("_key").alias(column), F.col("hashes").alias(f"{side}_hashes"))
        near = near.join(other, column, "left")
    shared = near.select("_key", "own_hashes", "before_hashes", "behind_hashes").mapInArrow(
        _templates, "_key bigint, shared array<int>"
    )
    # the pages are read and parsed a second time here rather than kept and moved with their blocks
    joined = rows.join(shared, "_key", "left").select(*carried, TEXT, "shared")
    schema = T.StructType([joined.schema[c] for c in carried] + [T.StructField("main_text", T.StringType())])

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, TEXT):
                made = [
                    " ".join(kept(blocks(t.decode("utf-8", "replace")), s))
                    for t, s in zip(texts, part.column("shared").to_pylist())
                ]
                columns = [*(part.column(c) for c in carried), pa.array(made, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, "main_text"])

    return joined.mapInArrow(run, schema).toDF(*carried.values(), "main_text")


def _templates(batches):
    for batch in batches:
        columns = (batch.column(f"{side}_hashes").to_pylist() for side in ("own", "before", "behind"))
        places = [template(own, [before, behind]) for own, before, behind in zip(*columns)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_key"), pa.array(places, pa.list_(pa.int32()))], names=["_key", "shared"]
        )


def digest(extracted: DataFrame) -> DataFrame:
    text = F.col("main_text")
    return extracted.select("page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars"))
