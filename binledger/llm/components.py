"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.staging import staged


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """id and component (the smallest id reachable) of every id that occurs in
    ``links``; ids are numbers or strings.

    Rounds of two steps: each id's larger neighbours move to its smallest neighbour
    (large star), then each id and its smaller neighbours move to the smallest of them
    (small star). Links never grow in number, and a round is two aggregations and joins by
    id that adaptive execution may split, so an id with very many links is no single task.
    Every round is written to the shared folder. Ends when a round changes nothing; the
    rounds grow with the logarithm of the longest chain. Links of an id to itself and
    repeated links make no difference; rows with a missing id are left out; no links give
    no rows.
    """
    start, end = F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b")
    links = links.select(start, end).dropna().select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # Written first, as they may be dear to make and are needed for ids and rounds.
    links = staged(links.distinct(), "component-links")
    ids, edges = links.select("a").union(links.select("b")).distinct(), links.filter("a <> b")
    state = None
    for _ in range(max_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = moved.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "component-links")
        # Equal sums of hashes over two rounds: nothing has moved.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled links are stars: every id but the smallest has one link, to the smallest.
    return ids.join(edges.withColumnRenamed("a", "_id"), F.col("a") == F.col("_id"), "left").select(
        F.col("a").alias("id"), F.coalesce("b", "a").alias("component")
    )
