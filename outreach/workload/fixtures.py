"""The domain tables of the workload, derived from the star-schema tables.

Every table is computed from whole input tables and grows with them. `oracle.py` states
the same rules a second time in SQL.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outreach.params import POS, RunParams
from outreach.sources.staging import stage
from outreach.sources.tables import TableSource, read_table

RUN = RunParams(run_date=dt.date(2001, 8, 1))

# Module types, outer segments and templates of the workload.
MODULE_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
MARKET_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PLACEMENTS = ["subject", "hero", "banner", "body"]
CHANNELS = ["email", "app", "web", "push", "sms"]
TEMPLATES = [
    "Hello",
    "def|In %%traveler.city%%",
    "def|A %%traveler.city%%|B %%content.best%%|C",
    "",
    "Deal|Welcome %%traveler.mktsegment%%",
    "def|%%content.best%% near %%traveler.city%%",
    None,
    "x|plain|%%traveler.city%% and %%traveler.city%%",
]
SPEC = "traveler.city|content.city"
CONTENT_COLUMNS = ["city", "mktsegment"]


def _numbered(value: Column, names: list[str | None], start: int) -> Column:
    out = None
    for i, name in enumerate(names):
        out = (F.when if out is None else out.when)(value == name, start + i)
    return out


def _pick(index: Column, names: list[str | None]) -> Column:
    return F.get(F.array(*[F.lit(n).cast("string") for n in names]), index)


def _test(test_id: int, kind: str, segment: int, module_type: Column, arm: Column) -> Column:
    return F.struct(
        F.lit(test_id).alias("test_id"), F.lit(kind).alias("test_type"),
        F.lit(segment).alias("segment_type_id"), module_type.alias("module_type_id"),
        arm.alias("control_test_flag"),
    )


class Domain:
    """Lazily built domain tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.source = TableSource(root=sf_dir)

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, name, self.source)

    @cached_property
    def pos_of_nation(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            "n_nationkey",
            "n_name",
            F.col("n_regionkey").alias("tpid"),
            (F.col("n_nationkey") % 2).alias("eapid"),
            F.concat(F.lit("en_"), F.lower(F.substring("r_name", 1, 2))).alias("locale"),
        )

    @cached_property
    def pos(self) -> DataFrame:
        return self.pos_of_nation.select(*POS).distinct()

    @cached_property
    def traveler(self) -> DataFrame:
        c, n = self.raw("customer"), self.pos_of_nation
        key = F.col("c_custkey")
        shared = F.when(key % 40 == 0, key + 1).otherwise(key)  # two people, one address
        return c.join(n, c.c_nationkey == n.n_nationkey).select(
            key.alias("user_id"),
            F.concat(F.lit("user"), shared.cast("string"), F.lit("@example.com")).alias("email_address"),
            *POS,
            (key % 100).cast("int").alias("test_keys"),
            (F.col("c_acctbal") > 0).cast("int").alias("mer_status"),
            F.when(key % 97 != 0, key).alias("paid"),
            F.when(key % 11 != 0, F.col("n_name")).alias("city"),
            F.col("c_mktsegment").alias("mktsegment"),
            F.col("c_acctbal").alias("acctbal"),
            F.col("c_name").alias("first_name"),
        )

    @cached_property
    def traveler_sets(self) -> DataFrame:
        """Travelers with all their segment ids: the market segment, 6 and 7 by balance."""
        b = F.col("acctbal")
        ids = F.array(
            _numbered(F.col("mktsegment"), MARKET_SEGMENTS, 1),
            F.when(b.between(0, 6000), 6),
            F.when(b > 5000, 7),
        )
        ids = F.filter(ids, lambda s: s.isNotNull())
        return self.traveler.withColumn("segments", ids).withColumn(
            "segment_set", F.array_join(F.transform("segments", lambda s: s.cast("string")), "#")
        )

    @cached_property
    def traveler_segment(self) -> DataFrame:
        return self.traveler_sets.select(
            "email_address", "test_keys", *POS, F.explode("segments").alias("segment_type_id"), "segment_set"
        )

    @cached_property
    def segment(self) -> DataFrame:
        seg = F.col("segment_type_id")
        return (
            self.pos.select("tpid", "eapid").distinct()
            .withColumn("segment_type_id", F.explode(F.sequence(F.lit(1), F.lit(7))))
            .withColumn("segment_deleted_flag", ((seg + F.col("tpid")) % 6 == 3).cast("int"))
        )

    @cached_property
    def campaign(self) -> DataFrame:
        s, n = self.raw("supplier"), self.pos_of_nation
        key = F.col("s_suppkey").cast("int")
        seg = key % 7 + 1
        day = F.when(key % 3 == 2, F.lit(dt.date(2001, 8, 2))).otherwise(F.lit(RUN.run_date))
        return s.join(n, s.s_nationkey == n.n_nationkey).select(
            F.col("s_suppkey").alias("id"),
            key.alias("campaign_id"),
            *POS,
            seg.alias("campaign_segment_type_id"),
            (key * 3 % 5 + 1).alias("priority"),
            (F.col("s_acctbal") < -300).cast("int").alias("campaign_deleted_flag"),
            day.alias("launch_date"),
            F.concat(day.cast("string"), F.lit("T00:00:00Z")).alias("launch_time_utc"),
            F.concat(
                F.lit("EML..PROG"), seg.cast("string"), F.lit(".CODE"), F.col("tpid").cast("string"),
                F.when(seg == 5, "").otherwise(".INTENT"),
            ).alias("program_type"),
            (key % 10 + 1).alias("template_id"),
            F.concat(F.lit("AUD_"), key.cast("string")).alias("audience_name"),
            (key % 3 + 1).alias("campaign_type_id"),
        )

    @cached_property
    def manual_launch(self) -> DataFrame:
        """Campaigns of suppliers with a high balance were sent by hand."""
        s = self.raw("supplier").where(F.col("s_acctbal") > 9000)
        return self.campaign.join(s, F.col("id") == F.col("s_suppkey")).select(
            "campaign_id", "locale", "launch_date"
        )

    @cached_property
    def parts(self) -> DataFrame:
        kind = _numbered(F.col("p_type"), MODULE_TYPES, 1)
        return self.raw("part").select(
            F.col("p_partkey").cast("int").alias("module_id"), kind.alias("module_type_id"),
            F.col("p_size").alias("size"), F.col("p_type").alias("module_type"),
            F.substring_index("p_brand", "#", -1).cast("int").alias("brand"),
        )

    @cached_property
    def module(self) -> DataFrame:
        key, kind = F.col("module_id"), F.col("module_type_id")
        serial = F.floor(key / 10).cast("int")  # number within the point of sale
        site = self.parts.select(
            key,
            (key % 5).alias("tpid"),
            (F.floor(key / 5).cast("int") % 2).alias("eapid"),
            kind,
            _pick(kind % 4, PLACEMENTS).alias("placement_type"),
            _pick(F.col("brand") % 5, CHANNELS).alias("channel"),
            _pick(serial % 10, ["active published"] * 8 + ["draft", "test published"]).alias("status"),
            (F.col("size") % 5 + 1).alias("version"),
            "module_type",
            (serial % 2).alias("default_flag"),
            "size",
        )
        return site.join(self.pos, ["tpid", "eapid"])

    @cached_property
    def segment_module_map(self) -> DataFrame:
        kind, seg = F.col("module_type_id"), F.col("segment_type_id")
        return stage(
            self.parts.select(kind, (F.col("size") % 7 + 1).alias("segment_type_id")).distinct()
            .withColumn("segment_module_map_id", kind * 10 + seg)
            .withColumn("module_priority_in_slot", seg * 10 + kind)
            .withColumn("seg_mod_deleted_flag", ((kind * 10 + seg) % 11 == 0).cast("int"))
        )  # the table it stands for is read several times

    @cached_property
    def template(self) -> DataFrame:
        kind, map_id, slot = F.col("module_type_id"), F.col("segment_module_map_id"), F.col("slot_position")
        first = kind % 4 + 1
        # module types with an even id may also fill the next slot
        slots = F.when((kind % 2 == 0) & (first < 4), F.array(first, first + 1)).otherwise(F.array(first))
        return (
            self.segment_module_map.select(kind, map_id)
            .withColumn("template_id", F.explode(F.sequence(F.lit(1), F.lit(10))))
            .withColumn("slot_position", F.explode(slots))
            .select(
                "template_id", map_id, slot,
                _pick(kind % 4, PLACEMENTS).alias("placement_type"),
                _pick(F.col("template_id") % 5, CHANNELS).alias("channel"),
                ((F.col("template_id") * 3 + map_id) % 13 == 0).cast("int").alias("template_deleted_flag"),
            )
        )

    @cached_property
    def module_variable(self) -> DataFrame:
        """Two variables per module; modules of size 50 have none."""
        position, serial = F.col("var_position"), F.floor(F.col("module_id") / 10).cast("int")
        return (
            self.module.where(F.col("size") != 50).select("module_id", *POS)
            .withColumn("var_position", F.explode(F.array(F.lit(1), F.lit(2))))
            .withColumn("source_connection", serial % 2 + 1)
            .withColumn("var_source", F.when(position == 1, SPEC).otherwise(""))
            .withColumn("var_structure", _pick((serial + position) % 8, TEMPLATES))
        )

    @cached_property
    def variables(self) -> DataFrame:
        from outreach.operators.metadata import backfill_source

        return backfill_source(self.module_variable)

    @cached_property
    def content(self) -> DataFrame:
        n, s = self.pos_of_nation, self.raw("supplier")
        best = F.min("s_name")
        return (
            n.join(s, n.n_nationkey == s.s_nationkey, "left")
            .groupBy(*POS, F.col("n_name").alias("city"), "n_nationkey")
            .agg(F.when(F.col("n_nationkey") % 5 != 0, best).alias("best"))
            .select(*POS, "city", "best")
        )

    @cached_property
    def booking(self) -> DataFrame:
        o, t = self.raw("orders"), self.traveler
        made = F.col("o_orderdate")
        return o.join(t, o.o_custkey == t.user_id).select(
            F.upper("email_address").alias("email_address"), "tpid", "eapid", "test_keys",
            made.alias("create_date"),
            (made + F.expr("INTERVAL 10 DAYS")).alias("booking_start"),
            (made + F.expr("INTERVAL 17 DAYS")).alias("booking_end"),
            (made + F.expr("INTERVAL 30 DAYS")).alias("etl_update_date"),
        )

    @cached_property
    def notification(self) -> DataFrame:
        e, t = self.raw("events"), self.traveler
        return e.join(t, e.user_id == t.user_id).select(
            F.upper("email_address").alias("email_address"), "tpid", "eapid", "test_keys",
            F.col("ts").alias("create_date"), "event_type",
        )

    @cached_property
    def run_log(self) -> DataFrame:
        ts = F.col("ts")
        return self.raw("events").select(
            F.col("event_id").alias("log_id"),
            F.col("user_id").cast("int").alias("source_id"),
            F.col("event_type").alias("source_name"),
            (F.col("value") > 20).cast("int").alias("is_complete"),
            ts.alias("start_date"),
            (ts + F.expr("INTERVAL 1 SECOND") * F.floor(F.col("value") * 60)).alias("end_date"),
            F.concat(F.lit("/data/run/"), F.col("event_id").cast("string")).alias("file_path"),
            F.floor(F.col("value") * 100).cast("int").alias("row_counts"),
        )

    @cached_property
    def booked_as_of(self) -> Column:
        return self.raw("orders").agg(F.max("o_orderdate")).scalar()

    @cached_property
    def notified_as_of(self) -> Column:
        return self.raw("events").agg(F.max("ts")).scalar()

    @cached_property
    def seed(self) -> DataFrame:
        s, n = self.raw("supplier"), self.pos_of_nation
        return s.join(n, s.s_nationkey == n.n_nationkey).select(
            *POS,
            F.concat(F.lit("seed"), F.col("s_suppkey").cast("string"), F.lit("@example.com")).alias("seed_email"),
            (F.col("s_acctbal") > 0).cast("int").alias("is_active"),
            F.when(F.col("s_acctbal") < 8000, "Merch").otherwise("Other").alias("category"),
        )

    @cached_property
    def schedule(self) -> DataFrame:
        """First urgent order of the customer with the campaign's number; some have none."""
        o = self.raw("orders").where(F.col("o_orderpriority") == "1-URGENT")
        first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("scheduled_launch_time"))
        c = self.campaign.select("campaign_id", "locale")
        return c.join(first, c.campaign_id == first.o_custkey).drop("o_custkey")

    @cached_property
    def job_schedule(self) -> DataFrame:
        """The other schedule table: the last order instead of the first urgent one."""
        last = self.raw("orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("scheduled_launch_time"))
        c = self.campaign.select("campaign_id", "locale")
        return c.join(last, c.campaign_id == last.o_custkey).drop("o_custkey")

    @cached_property
    def enabled_locale(self) -> DataFrame:
        """Locales of the regions whose name starts with A, in capitals."""
        return (
            self.raw("region").where(F.col("r_name").startswith("A"))
            .select(F.concat(F.lit("EN_"), F.upper(F.substring("r_name", 1, 2))).alias("locale"))
        )

    def _account(self, keep: Column) -> DataFrame:
        return self.raw("customer").where(keep).withColumn("paid", F.col("c_custkey"))

    @cached_property
    def token_a(self) -> DataFrame:
        return self._account(F.col("c_acctbal") >= 4000).select(
            "paid", F.md5(F.concat(F.lit("a"), F.col("paid").cast("string"))).alias("token")
        )

    @cached_property
    def token_b(self) -> DataFrame:
        return self._account(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
            "paid", F.md5(F.concat(F.lit("b"), F.col("paid").cast("string"))).alias("token")
        )

    @cached_property
    def loyalty(self) -> DataFrame:
        members = self._account(F.col("c_mktsegment") != "FURNITURE")
        n = self.pos_of_nation
        return members.join(n, members.c_nationkey == n.n_nationkey).select(
            "tpid", "paid",
            F.concat(F.lit("M"), F.col("paid").cast("string")).alias("member_id"),
            F.col("c_mktsegment").alias("tier_name"),
            F.floor("c_acctbal").cast("long").alias("available_points"),
            F.when(F.col("c_acctbal") > 0, "Active").otherwise("Closed").alias("status"),
        )

    @cached_property
    def pos_mapping(self) -> DataFrame:
        return self.pos.select(
            "tpid", "eapid",
            F.when(F.col("eapid") == 0, "HOME").otherwise("PARTNER").alias("brand"),
            F.concat(F.lit("P"), F.col("tpid").cast("string"), F.lit(" ")).alias("posa"),
        )

    @cached_property
    def test_assignment(self) -> DataFrame:
        """Version tests 1 and 2 (three arms, arm 0 is control) and type test 11 (two
        arms), one row per test key of every point of sale."""
        keys = self.traveler.select(*POS, "test_keys").distinct()
        tested = (
            self.module.where(F.col("status") == "test published")
            .groupBy(*POS, "module_type_id")
            .agg(F.min("module_id").alias("_low"), F.max("module_id").alias("_high"))
        )
        key = F.col("test_keys")
        tests = F.array(
            _test(1, "module version", 1, F.lit(1), key % 3),
            _test(2, "module version", 6, F.lit(2), key % 3),
            _test(11, "module type", 6, F.when(key % 2 == 0, 5).otherwise(1), key % 2),
        )
        rows = keys.select(*POS, "test_keys", F.inline(tests))
        arm = F.col("control_test_flag")
        version = F.col("test_type") == "module version"
        placed = rows.join(tested, [*POS, "module_type_id"], "left").select(
            "test_id", "test_type", *POS, "test_keys", "segment_type_id", "module_type_id",
            (F.col("module_type_id") * 10 + F.col("segment_type_id")).alias("segment_module_map_id"),
            F.when(version & (arm == 1), F.col("_low")).when(version & (arm == 2), F.col("_high")).alias("module_id"),
            arm.alias("control_test_flag"),
            F.when(arm == 0, "control").otherwise("treatment").alias("t_c_flag"),
        )
        return stage(placed)  # read several times, as the table it stands for would be


class DemotingDomain(Domain):
    """The same tables, but no module has a default and most cities look nothing up, so
    that many campaigns turn out unusable and addresses fall through several of them."""

    @cached_property
    def module(self) -> DataFrame:
        return super().module.withColumn("default_flag", F.lit(0))

    @cached_property
    def content(self) -> DataFrame:
        nations = self.raw("nation").select(F.col("n_name").alias("city"), "n_nationkey")
        found = super().content.join(nations, "city")
        return found.select(*POS, "city", F.when(F.col("n_nationkey") % 5 == 1, F.col("best")).alias("best"))
