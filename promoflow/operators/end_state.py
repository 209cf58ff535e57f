"""The audience after a batch, without a moved or stored row for each offer and member (K5, K1).

Offers and the members of their lists both grow with the input, so the audience a batch
leaves grows with their product, and so do the spells it is made of.  What decides a row is
small: the lists that an offer's events brought, and the lists a member is in.  Both meet in
tiles, a block of one list's members with a group of the offers that list is the last of; the
rows of a tile are written out above that join, where they are read or stored, and move no more.

Walking back from an offer's last round, a member's spell begins after the first list that
the member is not in, and only the last time a list was brought counts for that.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoflow.operators.joins import kept

#: Members of a block, about, and offers of a group, about.
BLOCK, GROUP = 2048, 1024
#: A list that nobody is in (an event without a list), and the state before the first round.
_NO_LIST, _STORED = -1, -2


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.membership_uuid").eqNullSafe(F.col(f"{b}.membership_uuid"))


class EndState:
    """What a batch leaves of the audience, and what it changes in it.

    ``current``: the stored audience (offer_id, membership_uuid, membership_id, propensity);
    ``targets``: (offer_id, round, list_key) of the effective lists, numbered from 1 in arrival
    order; ``new_members``: resolved list members.  Where both carry ``offer_source``, they
    meet on (list_key, offer_source).
    """

    def __init__(self, current: DataFrame, targets: DataFrame, new_members: DataFrame, block: int = BLOCK, group: int = GROUP):
        self.current, self.targets, self.new_members, self.block, self.group = current, targets, new_members, block, group
        self.by = ["list_key"] + ["offer_source"] * ("offer_source" in targets.columns and "offer_source" in new_members.columns)

    @cached_property
    def lists(self) -> DataFrame:
        """The lists of the batch (a file, as a source reads it), with a number each."""
        named = self.targets.select(*self.by).dropna().distinct()
        return kept(named.withColumn("list_id", F.monotonically_increasing_id()), "lists")

    @cached_property
    def programs(self) -> DataFrame:
        """(offer_id, last_id, list_ids, next_ids): the distinct lists of an offer from the last
        one back, and the list that came after each; the state before the batch ends them."""
        numbered = self.targets.join(self.lists, self.by, "left").select(
            "offer_id", "round", F.coalesce("list_id", F.lit(_NO_LIST)).alias("list_id"))
        rounds = kept(numbered, "rounds")
        begun = rounds.select("offer_id", F.lit(0).alias("round"), F.lit(_STORED).cast("bigint").alias("list_id")).distinct()
        ends = rounds.unionByName(begun).groupBy("offer_id", "list_id").agg(F.max("round").alias("round"))
        after = rounds.select("offer_id", (F.col("round") - 1).alias("round"), F.col("list_id").alias("next_id"))
        steps = ends.join(after, ["offer_id", "round"], "left").groupBy("offer_id").agg(
            F.sort_array(F.collect_list(F.struct((-F.col("round")).alias("back"), "list_id", "next_id"))).alias("steps"))
        return kept(steps.select("offer_id", F.col("steps")[0]["list_id"].alias("last_id"), F.col("steps.list_id").alias("list_ids"),
                                 F.col("steps.next_id").alias("next_ids")), "programs")

    @cached_property
    def people(self) -> DataFrame:
        """(membership_uuid, list_ids, rows): the lists a member is in, with the member's row in each."""
        row = F.min(F.struct("membership_id", "propensity")).alias("row")
        rows = self.new_members.groupBy(*self.by, "membership_uuid").agg(row).join(self.lists, self.by)
        mine = rows.groupBy("membership_uuid").agg(F.collect_list(F.struct("list_id", "row")).alias("mine"))
        return kept(mine.select("membership_uuid", F.col("mine.list_id").alias("list_ids"), F.col("mine.row").alias("rows")), "people")

    @cached_property
    def standing(self) -> DataFrame:
        """The stored audience of the offers of the batch: ``here`` where the last list has the
        member, ``stays`` where every list has, so that the stored row is kept."""
        offers = self.programs.select("offer_id", "last_id", F.col("list_ids").alias("all_ids"))
        x = (self.current.join(offers, "offer_id").alias("c")
             .join(self.people.select("membership_uuid", "list_ids").alias("p"), _same("c", "p"), "left"))
        mine = F.coalesce("p.list_ids", F.array().cast("array<bigint>"))
        x = x.select("offer_id", "c.membership_uuid", "membership_id", "propensity", "last_id", F.array_contains(mine, F.col("last_id")).alias("here"),
                     (F.size(F.array_except("all_ids", mine)) == 1).alias("stays"))
        row = F.min(F.when(F.col("stays"), F.struct("membership_id", "propensity"))).alias("row")
        return kept(x.groupBy("offer_id", "membership_uuid", "last_id", "here", "stays").agg(row), "standing")

    @cached_property
    def tiling(self) -> DataFrame:
        """(last_id, blocks, groups): how many blocks a last list's members and how many groups
        its offers are cut into."""
        members = self.people.select(F.explode("list_ids").alias("last_id")).groupBy("last_id").agg(F.count("*").alias("n"))
        offers = self.programs.groupBy("last_id").agg(F.count("*").alias("n_offers"))
        return kept(members.join(offers, "last_id").select(
            "last_id", F.ceil(F.col("n") / self.block).cast("int").alias("blocks"),
            F.ceil(F.col("n_offers") / self.group).cast("int").alias("groups")), "tiling")

    def _listed(self, less: DataFrame) -> DataFrame:
        """(offer_id, membership_uuid, row): every member of an offer's last list with the row of
        the spell that reaches it, but those that ``less`` (of ``standing``) holds."""
        tile = ["last_id", "block", "group"]
        n = int(self.people.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = less.groupBy("last_id", "membership_uuid").agg(F.collect_list("offer_id").alias("less"))
        mine = self.people.withColumn("last_id", F.explode("list_ids")).join(self.tiling, "last_id").alias("m")
        mine = mine.join(out.alias("o"), (F.col("m.last_id") == F.col("o.last_id")) & _same("m", "o"), "left").select(
            "m.*", F.coalesce("less", F.array().cast("array<bigint>")).alias("less"))
        blocks = (mine.groupBy("last_id", F.pmod(F.xxhash64("membership_uuid"), "blocks").cast("int").alias("block"), "groups")
                  .agg(F.collect_list(F.struct("membership_uuid", "list_ids", "rows", "less")).alias("members"))
                  .select("last_id", "block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), "members"))
        group = F.pmod(F.xxhash64("offer_id"), "groups").cast("int").alias("group")
        alike = (self.programs.join(self.tiling, "last_id").groupBy("last_id", F.col("list_ids").alias("all_ids"), "next_ids", "blocks", group)
                 .agg(F.collect_list("offer_id").alias("offer_ids")))
        offers = alike.select("offer_ids", "last_id", "all_ids", "next_ids", "group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        # Numbers of partitions are given: by their small bytes the tiles would end in few tasks.
        met = blocks.repartition(n, *tile).join(offers.repartition(n, *tile), tile)
        x = met.select("offer_ids", "last_id", "all_ids", "next_ids", F.explode("members").alias("m"))
        missing = F.get(F.array_except("all_ids", "m.list_ids"), F.lit(0))
        place = lambda ids, k: (F.array_position(ids, k) - 1).cast("int")
        begins = F.when(F.size("all_ids") == 2, F.col("last_id")).otherwise(F.get("next_ids", place("all_ids", missing)))
        # What a member has of offers with the same lists is found once, and then written out.
        x = x.select("m.membership_uuid", F.get("m.rows", place("m.list_ids", begins)).alias("row"),
                     F.when(F.size("m.less") == 0, F.col("offer_ids")).otherwise(F.array_except("offer_ids", "m.less")).alias("offer_ids"))
        return x.select(F.explode("offer_ids").alias("offer_id"), "membership_uuid", "row")

    @property
    def audience(self) -> DataFrame:
        """The stored audience after the batch: other offers' rows as they are, and of the offers
        of the batch the members of the last list."""
        cols = ["offer_id", "membership_uuid", "membership_id", "propensity"]
        flat = lambda df: df.select("offer_id", "membership_uuid", "row.membership_id", "row.propensity")
        stays = self.standing.filter("stays")
        others = self.current.join(self.programs.select("offer_id"), "offer_id", "left_anti").select(*cols)
        return others.unionByName(flat(stays)).unionByName(flat(self._listed(stays)))

    @property
    def changes(self) -> DataFrame:
        """(offer_id, membership_uuid, action) over all rounds: an ``add`` for a member that only
        the audience after the batch has, a ``delete`` for one that only the stored one has."""
        cols = ["offer_id", "membership_uuid"]
        adds = self._listed(self.standing.filter("here")).select(*cols, F.lit("add").alias("action"))
        return adds.unionByName(self.standing.filter(~F.col("here")).select(*cols, F.lit("delete").alias("action")))
