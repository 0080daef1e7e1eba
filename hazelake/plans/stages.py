"""Spark stage builders shared by the query catalog (mirrors the oracle CTE names)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from hazelake.functions.timeparse import parse_datetime
from hazelake.functions.units import normalize_units
from hazelake.operators import facts
from hazelake.operators.alerts import first_in_slot, flag_readings
from hazelake.operators.dedupe import dedupe
from hazelake.operators.outliers import remove_outliers_iqr
from hazelake.operators.quality import quality_gate, quality_report
from hazelake.operators.validate import validate_ranges
from hazelake.plans.pipeline import add_pm25_aqi, nan_to_null
from hazelake.session import materialize, reusable, utc
from hazelake.sources import fixtures
from hazelake.sources.listing import bronze_keys
from hazelake.streaming.readings import message_to_readings

RUN_KEYS = ["location_id", "run_date"]
FLOAT_STATS = ["value_avg", "value_median", "value_std"]


def ntz(df: DataFrame) -> DataFrame:
    """Zoned timestamps leave as wall-clock UTC (timestamp_ntz), like the driver tables."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def round6(df: DataFrame, cols=FLOAT_STATS) -> DataFrame:
    """Floating means/medians/std rounded to 6 places (summation order differs by engine)."""
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


class Stages:
    """Lazy DataFrames for one (session, sf_dir); nothing here triggers a job."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        utc(spark)
        self.spark, self.sf = spark, sf_dir
        self._memo: dict[str, DataFrame] = {}

    def _once(self, name: str, build) -> DataFrame:
        """Layer tables read by several branches are materialised once per query."""
        if name not in self._memo:
            self._memo[name] = materialize(build())
        return self._memo[name]

    def R(self) -> DataFrame:
        return fixtures.readings_with_defects(self.spark, self.sf)

    def D(self) -> DataFrame:
        return dedupe(nan_to_null(self.R()), keep="first")

    def N(self) -> DataFrame:
        return normalize_units(self.D())

    def T(self) -> DataFrame:
        return parse_datetime(self.N())

    def V(self) -> DataFrame:
        # lazy: operators that read it twice materialise it themselves (session.reusable)
        if "V" not in self._memo:
            self._memo["V"] = validate_ranges(self.T())
        return self._memo["V"]

    def I(self) -> DataFrame:
        return remove_outliers_iqr(self.V(), RUN_KEYS)

    def A(self) -> DataFrame:
        if "A" not in self._memo:
            self._memo["A"] = add_pm25_aqi(self.I())
        return self._memo["A"]

    def QR(self) -> DataFrame:
        return quality_report(self.A(), RUN_KEYS)

    def S(self) -> DataFrame:
        def build():
            a = reusable(self.A(), "cleaned")   # read by the report and by the gate
            return quality_gate(a, quality_report(a, RUN_KEYS), RUN_KEYS)
        return self._once("S", build)

    def HF(self) -> DataFrame:
        return round6(facts.hourly_fact(self.V()))

    def DF(self) -> DataFrame:
        return round6(facts.daily_fact(self.V()))

    def SHF(self) -> DataFrame:
        return round6(facts.hourly_fact(self.S()))

    def SDF(self) -> DataFrame:
        return round6(facts.daily_fact(self.S()))

    def DL(self) -> DataFrame:
        return facts.dim_location(self.S())

    def DP(self) -> DataFrame:
        return facts.dim_parameter(self.S())

    def DT(self) -> DataFrame:
        return facts.dim_time(self.S())

    def M(self, spread_out: bool = False) -> DataFrame:
        return fixtures.messages(self.spark, self.sf, spread_out)

    def P(self) -> DataFrame:
        return fixtures.payloads(self.spark, self.sf)

    def RD(self) -> DataFrame:
        return message_to_readings(self.M())

    def AL(self) -> DataFrame:
        return first_in_slot(self.RD())

    def RF(self) -> DataFrame:
        return flag_readings(self.RD())

    def L(self) -> DataFrame:
        # a listing is a stored column of paths; materialising the fixture keeps the long key
        # expression from being inlined into every parsing expression downstream
        return self._once("L", lambda: bronze_keys(self.R()))
