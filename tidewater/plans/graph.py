"""Model graph: staging -> intermediate -> marts -> reports and checks.

``ModelGraph`` exposes every model as a lazily built DataFrame; a model is
built once per graph and shared by the models that read it, so one
action over several models lets Catalyst reuse common exchanges.
``write_models`` materialises models in dependency order as Parquet tables
(facts partitioned by month) and reads each back, which cuts lineage the way
a table materialisation does; the folder changes from one whole build to the
next by a snapshot commit.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.dates import date_spine, ntz, spine_from_bounds
from tidewater.operators.quality import observe_checks, run_checks
from tidewater.operators.scd2 import scd2_initial, scd2_merge, scd2_splice
from tidewater.params import RunParams
from tidewater.plans import checks as ck
from tidewater.plans import derivations as dv
from tidewater.plans import intermediate as im
from tidewater.plans import marts as mt
from tidewater.plans import reports as rp
from tidewater.plans import rollup as ru
from tidewater.plans import staging as st
from tidewater.session import ensure_checkpoint_dir
from tidewater.sources import RawSources, snapshots


class ModelGraph:
    def __init__(self, spark: SparkSession, raw: RawSources, params: RunParams | None = None):
        self.spark = spark
        self.raw = raw
        self.params = params or RunParams()
        # Models that are stored tables; others are derived from what they read.
        self.stored: set[str] = set()
        # Failing rows by test name, counted while the models were written.
        self.observed: dict[str, int] = {}
        # Stored facts with the column of their month folders.
        self.by_month: dict[str, DataFrame] = {}

    # -- staging -----------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return st.stg_customers(self.raw.customers, self.params.load_stamp)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return st.stg_orders(self.raw.orders, self.params.load_stamp)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return st.stg_order_items(self.raw.order_items, self.params.load_stamp)

    @cached_property
    def stg_products(self) -> DataFrame:
        return st.stg_products(self.raw.products, self.params.load_stamp)

    @cached_property
    def stg_payments(self) -> DataFrame:
        return st.stg_payments(self.raw.payments, self.params.load_stamp)

    @cached_property
    def stg_events(self) -> DataFrame:
        return st.stg_events(self.raw.events, self.params.load_stamp)

    # -- intermediate ------------------------------------------------------
    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return im.orders_enriched(
            self.stg_orders, self.stg_order_items, self.stg_payments
        )

    @cached_property
    def int_customers_rfm_scored(self) -> DataFrame:
        return im.rfm_scored(
            self.stg_customers, self.stg_orders, self.stg_order_items, self.params
        )

    @cached_property
    def int_orders_attributed(self) -> DataFrame:
        return im.orders_attributed(self.stg_orders, self.stg_events, self.params)

    @cached_property
    def int_cohorts_monthly(self) -> DataFrame:
        return im.cohorts_monthly(self.stg_customers, self.stg_orders, self.params)

    # -- marts -------------------------------------------------------------
    @cached_property
    def date_spine(self) -> DataFrame:
        p = self.params
        if p.spine_start is not None and p.spine_end is not None:
            return date_spine(self.spark, p.spine_start, p.spine_end)
        # Whole calendar years holding any order or event (bounded by the calendar).
        days = self.stg_orders.select(F.to_date("order_at").alias("d")).unionByName(
            self.stg_events.select(F.to_date("event_at").alias("d"))
        )
        bounds = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).select(
            F.trunc("lo", "year").alias("s"), F.add_months(F.trunc("hi", "year"), 12).alias("e")
        )
        return spine_from_bounds(bounds)

    @cached_property
    def dim_date(self) -> DataFrame:
        return mt.dim_date(self.date_spine)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return mt.dim_customers(self.int_customers_rfm_scored, self.int_orders_enriched)

    @cached_property
    def dim_products(self) -> DataFrame:
        return mt.dim_products(self.stg_products)

    @cached_property
    def dim_channels(self) -> DataFrame:
        return mt.dim_channels(self.stg_events)

    def customer_key_lookup(self) -> DataFrame:
        """(customer_id, customer_key, is_current) rows of the customer dimension.

        The dimension has exactly one current row per staged customer, keyed
        md5(customer_id), by construction (RFM base = staged customers, left
        joins only).  So until the dimension is materialised, the facts take
        the same key set from the staged customers instead of running the RFM
        ranking just to look up a key; afterwards they read the table.
        """
        if "dim_customers" in self.stored:
            return self.dim_customers.select("customer_id", "customer_key", "is_current")
        return mt.customer_keys(self.stg_customers)

    def customer_profile(self) -> DataFrame:
        """Customer dimension rows for reports that read no RFM column: the
        dimension itself once materialised, else staged customers + lifetime
        metrics (same rows and values, no RFM ranking)."""
        if "dim_customers" in self.stored:
            return self.dim_customers
        return mt.customer_profile(self.stg_customers, self.int_orders_enriched)

    @cached_property
    def order_lines(self) -> DataFrame:
        return mt.order_lines(
            self.stg_order_items, self.int_orders_enriched, self.int_orders_attributed,
            self.dim_date, self.customer_key_lookup(), self.dim_products, self.dim_channels,
        )

    @cached_property
    def fct_orders(self) -> DataFrame:
        return mt.order_keys(self.order_lines)

    @cached_property
    def event_rows(self) -> DataFrame:
        return mt.event_rows(
            self.stg_events, self.customer_key_lookup(), self.dim_date, self.dim_channels
        )

    @cached_property
    def fct_customer_events(self) -> DataFrame:
        return mt.event_keys(self.event_rows)

    # -- reports -----------------------------------------------------------
    @cached_property
    def sales_rollup(self) -> ru.SalesRollup:
        """The line fact summed up per day and channel; written when first asked for."""
        return ru.sales_rollup(self.fct_orders)

    def rollup_report(self, name: str) -> DataFrame:
        """A report over days or channels from the rollup instead of the lines; the same rows as ``report``."""
        table = {
            "kpi_summary": lambda: ru.kpi_summary(self.sales_rollup),
            "revenue_daily": lambda: ru.revenue_daily(self.sales_rollup, self.dim_date),
            "aov_monthly": lambda: ru.aov_monthly(self.sales_rollup, self.dim_date),
            "channel_revenue": lambda: ru.channel_revenue(self.sales_rollup, self.dim_channels),
        }
        return table[name]()

    def report(self, name: str) -> DataFrame:
        p = self.params
        table = {
            "kpi_summary": lambda: rp.kpi_summary(self.fct_orders),
            "repeat_customers": lambda: rp.repeat_customers(self.customer_profile()),
            "avg_clv": lambda: rp.avg_clv(self.customer_profile()),
            "revenue_daily": lambda: rp.revenue_daily(self.fct_orders, self.dim_date),
            "revenue_rolling7": lambda: rp.revenue_rolling7(self.fct_orders, self.dim_date),
            "aov_monthly": lambda: rp.aov_monthly(self.fct_orders, self.dim_date),
            "customer_growth": lambda: rp.customer_growth(self.customer_profile()),
            "segment_distribution": lambda: rp.segment_distribution(self.dim_customers),
            "segment_heatmap": lambda: rp.segment_heatmap(self.dim_customers),
            "revenue_share": lambda: rp.revenue_share(self.dim_customers),
            "segment_details": lambda: rp.segment_details(self.dim_customers),
            "channel_revenue": lambda: rp.channel_revenue(self.fct_orders, self.dim_channels),
            "first_order_channel": lambda: rp.first_order_channel(self.customer_profile(), self.int_orders_attributed),
            "retention_by_channel": lambda: rp.retention_by_channel(
                self.customer_profile(), self.int_orders_attributed, p.min_channel_customers
            ),
            "cohort_retention": lambda: rp.cohort_retention(self.int_cohorts_monthly, p.retention_days),
            "attribution_coverage": lambda: rp.attribution_coverage(self.int_orders_attributed),
        }
        return table[name]()

    def report_between(self, name: str, start: dt.date, end: dt.date) -> DataFrame:
        """A report on the line fact for the days from ``start`` to ``end`` (exclusive).

        Where the fact is stored in month folders, only those of the period are read.
        """
        if "fct_orders" in self.by_month:
            month = self.PARTITION_BY["fct_orders"]
            lines = rp.between(self.by_month["fct_orders"], self.dim_date, start, end, month).drop(month)
        else:
            lines = rp.between(self.fct_orders, self.dim_date, start, end)
        table = {
            "kpi_summary": lambda: rp.kpi_summary(lines),
            "revenue_daily": lambda: rp.revenue_daily(lines, self.dim_date),
            "revenue_rolling7": lambda: rp.revenue_rolling7(lines, self.dim_date),
            "aov_monthly": lambda: rp.aov_monthly(lines, self.dim_date),
            "channel_revenue": lambda: rp.channel_revenue(lines, self.dim_channels),
        }
        return table[name]()

    # -- checks ------------------------------------------------------------
    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    def singular_checks(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "assert_attribution_coverage": lambda: ck.coverage_failures(self.int_orders_attributed),
            "assert_no_orders_before_signup": lambda: ck.orders_before_signup(self.stg_orders, self.stg_customers),
            "assert_rfm_scores_valid": lambda: ck.invalid_rfm_scores(self.int_customers_rfm_scored),
        }

    def check_results(self, kinds: tuple[str, ...] | None = None, materialize: bool = True) -> DataFrame:
        """Run the declared and singular checks (optionally of some kinds).

        Like a build-then-test run, the models the checks read are first
        written once as tables (``materialize``), so the checks scan stored
        columns instead of re-deriving each model per check.  Row-local checks
        are counted during that write and need no scan at all.
        """
        checks = [c for c in ck.DECLARED + ck.SINGULAR if kinds is None or c.kind in kinds]
        if materialize:
            needed = {c.model for c in checks} | {c.to_model for c in checks if c.to_model}
            wanted = self._closure(needed) - self.stored
            self.materialize(tuple(n for n in self.MODEL_ORDER if n in wanted))
        return run_checks(checks, self.model, self.singular_checks(), self.observed)

    # upstream models of each materialisable model
    DEPENDS = {
        "dim_customers": ("int_customers_rfm_scored", "int_orders_enriched"),
        "fct_orders": ("int_orders_enriched", "int_orders_attributed", "dim_date", "dim_customers", "dim_products",
                       "dim_channels"),
        "fct_customer_events": ("dim_customers", "dim_date", "dim_channels"),
    }

    def _closure(self, names: set[str]) -> set[str]:
        out, todo = set(), list(names)
        while todo:
            n = todo.pop()
            if n not in out:
                out.add(n)
                todo.extend(self.DEPENDS.get(n, ()))
        return out

    def materialize(self, names: tuple[str, ...], root: str | None = None) -> dict[str, str]:
        """Write ``names`` (in dependency order) under ``root``, by default a
        fresh folder inside the session's checkpoint folder (shared storage
        on a cluster), and read them back for everything downstream.  These
        are working tables, so facts are not split into month folders."""
        if root is None:
            root = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/tables-{uuid.uuid4().hex[:12]}"
        return self._write_all(names, lambda name: f"{root.rstrip('/')}/{name}", 4, False)

    # -- derivations -------------------------------------------------------
    def derivation(self, name: str) -> DataFrame:
        r = self.raw
        table = {
            "line_pricing": lambda: dv.line_pricing(r.order_items, r.orders, r.products),
            "payments_derived": lambda: dv.payments_derived(r.orders, r.order_items),
            "session_ids": lambda: dv.session_ids(r.events),
            "first_orders": lambda: dv.first_orders(r.orders),
            "audit_row_counts": lambda: dv.audit_row_counts(r.as_dict()),
        }
        return table[name]()

    # -- SCD2 history ------------------------------------------------------
    def segment_history(self, previous_as_of) -> DataFrame:
        """Customer segment history over two runs: the run at ``previous_as_of``
        seeds the history, the current run is merged into it."""
        tracked = ["recency_score", "frequency_score", "monetary_score", "rfm_segment"]
        prev = ModelGraph(self.spark, self.raw, dataclasses.replace(self.params, as_of=previous_as_of))

        def snap(p: "ModelGraph") -> DataFrame:
            return p.int_customers_rfm_scored.select("customer_id", *tracked)

        history = scd2_initial(snap(prev), key="customer_id", effective_from=ntz(previous_as_of),
                               history_key="customer_history_key")
        return scd2_merge(history, snap(self), key="customer_id", tracked=tracked, change_at=self.params.as_of,
                          history_key="customer_history_key")

    def active_segment_history(self, arrivals) -> DataFrame:
        """Segment history of the customers who ordered in the trailing window, from the runs at ``arrivals``.

        The runs are given in the order in which they arrive, which need not be
        that of their times.  A customer without an order in the window is
        missing from that run, so their version ends there.
        """
        def snap(as_of) -> DataFrame:
            p = ModelGraph(self.spark, self.raw, dataclasses.replace(self.params, as_of=as_of))
            return p.int_customers_rfm_scored.where("order_count_12m > 0").select("customer_id", "rfm_segment")

        first, *others = arrivals
        history = scd2_initial(snap(first), key="customer_id", effective_from=ntz(first), history_key="customer_history_key")
        observed = [first]
        for at in others:
            history = scd2_splice(history, snap(at), key="customer_id", tracked=["rfm_segment"], at=at, observed=observed,
                                  history_key="customer_history_key")
            observed.append(at)
        return history

    # -- materialisation ---------------------------------------------------
    MODEL_ORDER = (
        "int_orders_enriched", "int_customers_rfm_scored", "int_orders_attributed", "int_cohorts_monthly",
        "dim_date", "dim_customers", "dim_products", "dim_channels", "fct_orders", "fct_customer_events",
    )
    PARTITION_BY = {"fct_orders": "order_month", "fct_customer_events": "event_month"}

    def write_models(
        self, out_dir: str, names: tuple[str, ...] | None = None, threads: int = 4, partition_facts: bool = True
    ) -> dict[str, str]:
        """Write models as Parquet tables and publish them together; (model -> folder of the written version).

        Every table goes to a folder of its own, and one snapshot commit at the
        end makes all of them the state of ``out_dir``: a reader of the folder
        (``open_models``) sees the build before or this one, never a mixture,
        and a build that stops midway changes nothing.  Models that are not
        among ``names`` stay as they are.
        """
        based_on, _ = snapshots.current(self.spark, out_dir)
        paths = self._write_all(names, lambda name: snapshots.new_version(out_dir, name), threads, partition_facts)
        snapshots.commit(self.spark, out_dir, based_on, paths)
        return paths

    def _write_all(
        self, names: tuple[str, ...] | None, place: Callable[[str], str], threads: int, partition_facts: bool
    ) -> dict[str, str]:
        """Write models in dependency order; downstream models then read the
        written tables (lineage is cut at each table).

        Models whose upstream models are written run concurrently, up to
        ``threads`` at a time (Spark runs jobs from several driver threads
        side by side).  Facts are partitioned by month for partition pruning
        on date filters (``partition_facts``); before that write they are
        range-partitioned on their timestamp, so each task writes one or two
        month folders instead of one file per month, and a busy month is
        still spread over several tasks by the sampled range bounds.
        """
        todo = [n for n in self.MODEL_ORDER if n in set(self.MODEL_ORDER if names is None else names)]
        for stg in ("stg_customers", "stg_orders", "stg_order_items", "stg_products", "stg_payments", "stg_events"):
            getattr(self, stg)  # build shared lazy inputs once, before any thread starts
        paths: dict[str, str] = {}
        while todo:
            ready = [n for n in todo if not any(d in todo for d in self.DEPENDS.get(n, ()))]
            with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
                written = list(pool.map(lambda n: (n, self._write_one(place(n), n, partition_facts)), ready))
            for name, path in written:
                self._use(name, path)  # downstream reads the table
                paths[name] = path
            todo = [n for n in todo if n not in ready]
        return paths

    def _use(self, name: str, path: str) -> None:
        table = self.spark.read.parquet(path)
        part = self.PARTITION_BY.get(name)
        self.by_month.pop(name, None)
        if part in table.columns:
            self.by_month[name] = table = table.withColumn(part, F.col(part).cast("string"))
            table = table.drop(part)
        self.__dict__[name] = table
        self.stored.add(name)

    def open_models(self, folder: str) -> list[str]:
        """Read the models that ``write_models`` published in ``folder`` instead of deriving them; their names.

        All are of one snapshot, also while the folder is being refreshed.
        """
        _, tables = snapshots.current(self.spark, folder)
        found = [n for n in self.MODEL_ORDER if n in tables]  # the others are derived when asked for
        for name in found:
            for c in ck.DECLARED:
                if c.model == name:  # counted for another version, if at all
                    self.observed.pop(c.test_name, None)
            self._use(name, tables[name])
        return found

    def _write_one(self, path: str, name: str, partition_facts: bool = True) -> str:
        df, split = self.model(name), []
        part = self.PARTITION_BY.get(name)
        if part and partition_facts:
            ts = "order_at" if name == "fct_orders" else "event_at"
            df, split = self._by_time(name, ts).withColumn(part, F.date_format(ts, "yyyy-MM")), [part]
        # after the exchange, so that the counts are taken in the stage that writes
        df, counts = observe_checks(df, [c for c in ck.DECLARED if c.model == name])
        # keys are hex digests, which only an entropy coder makes smaller
        df.write.mode("errorifexists").partitionBy(*split).option("compression", "zstd").parquet(path)
        self.observed |= counts()
        return path

    def _by_time(self, name: str, ts: str) -> DataFrame:
        """A fact range-partitioned on its timestamp; its keys are made after the exchange."""
        if name in self.stored:
            return self.model(name).repartitionByRange(F.col(ts))
        rows, keys = ("order_lines", mt.order_keys) if name == "fct_orders" else ("event_rows", mt.event_keys)
        return keys(self.model(rows).repartitionByRange(F.col(ts)))
