"""Run bronze -> silver -> gold (or a named subset) in one Spark application, by dependencies.

A step is a table made from other tables. It starts as soon as the steps that it reads have ended, a few at a
time from threads; it reads the latest committed batch of its inputs, builds one lazy
plan, and writes one batch (same stamp for the whole run, so a run's
tables line up). Layer edges are written tables in the lake: they cut the
lineage, so a lost executor recomputes from the last written layer, never
from the raw sources. A batch records which attempts it was made from.

Steps do not fall with one another. Each ends in an ``Outcome``: made; current (its latest batch is made from its inputs'
latest); rejected (the data does not allow it: nothing is left, a column is missing, a value does not cast); failed
(storage or the cluster); blocked (a step that it reads was rejected, failed or blocked); waiting (an
input has no batch). A step that reads none of the broken ones is made all the same. A rejection is recorded in the table's log
with the inputs that it was made from, and is not tried again until one of these moves on; what failed is tried again by the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    DateTimeException,
    NumberFormatException,
)
from pyspark.sql import DataFrame, SparkSession

from tiermart.plans import gold, silver
from tiermart.sources import lake
from tiermart.sources.lake import LakeConfig
from tiermart.sources.readers import ingest

LAYERS = ("bronze", "silver", "gold")
TABLES = ("customers", "policies", "claims", "vehicles", "agents", "payments")
AT_ONCE = 4


MADE, CURRENT, REJECTED, FAILED, BLOCKED, WAITING = "made", "current", "rejected", "failed", "blocked", "waiting"
BROKEN = (REJECTED, FAILED, BLOCKED)

# Error conditions that a batch's own content causes, beside those with an exception class of their own.
_CONTENT = ("UNRESOLVED_COLUMN", "FIELD_NOT_FOUND", "DATATYPE_MISMATCH", "CAST_INVALID_INPUT", "COLUMN_NOT_FOUND")


def content_fault(exc: Exception) -> bool:
    """Is the data to blame, so that another run would meet the error again? A path that is not there is storage's fault."""
    if isinstance(exc, (ArithmeticException, DateTimeException, NumberFormatException)):
        return True
    if isinstance(exc, AnalysisException):
        return (exc.getCondition() or "").startswith(_CONTENT)
    return isinstance(exc, ValueError)


@dataclass(frozen=True)
class Outcome:
    """How a step ended: the path of its batch if it has one, or the reason why it was not made."""

    status: str
    path: str | None = None
    reason: str | None = None


class IncompleteRun(RuntimeError):
    """Some steps were not made; ``outcomes`` has all steps'."""

    def __init__(self, outcomes: dict[str, Outcome]):
        self.outcomes = outcomes
        super().__init__("; ".join(f"{n} {o.status}: {o.reason}" for n, o in outcomes.items()
                                   if o.status not in (MADE, CURRENT)))


def not_made(exc: Exception) -> Outcome:
    """What an error makes of a step; an error that storage wraps is judged by what is in it."""
    cause = exc.__cause__ if isinstance(exc, RuntimeError) and isinstance(exc.__cause__, Exception) else exc
    if content_fault(cause):
        return Outcome(REJECTED, reason=f"{type(cause).__name__}: {cause}"[:2000])
    return Outcome(FAILED, reason=f"{type(exc).__name__}: {exc}"[:2000])


@dataclass(frozen=True)
class Step:
    """A table made from other tables: ``build(*inputs, as_of)``. Inputs are read from ``reads``' layer."""

    layer: str
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    reads: str = "silver"

    def current(self, spark: SparkSession, config: LakeConfig) -> dict[str, str]:
        """Attempts that the inputs' latest batches are."""
        return {n: lake.load_path(spark, config, self.reads, n) for n in self.inputs}

    def run(self, spark: SparkSession, config: LakeConfig, as_of: str, stamp: str) -> str:
        """Empty inputs raise (by their log entries), an empty output raises and commits nothing."""
        return self.write(spark, config, as_of, stamp, self.current(spark, config))

    def write(self, spark: SparkSession, config: LakeConfig, as_of: str, stamp: str, paths: dict[str, str]) -> str:
        df = self.build(*[lake.read_input(spark, p) for p in paths.values()], as_of)
        return lake.save(df, config, self.layer, self.name, stamp, inputs=paths)

    def attempt(self, spark: SparkSession, config: LakeConfig, as_of: str, stamp: str, again: bool) -> Outcome:
        """Make the table; unless ``again``, only if its inputs have moved on since it was made or rejected."""
        try:
            try:
                paths = self.current(spark, config)
            except FileNotFoundError as exc:
                return Outcome(WAITING, reason=str(exc))
            table = lake.table_path(config.root, self.layer, self.name)
            if not again:
                made = lake.latest(spark, table)
                if made and lake.batch_metadata(spark, made)["inputs"] == paths:
                    return Outcome(CURRENT, made)
                known = lake.last_rejection(spark, table)
                if known and known["inputs"] == paths:
                    return Outcome(REJECTED, reason=known["reason"])
            try:
                return Outcome(MADE, self.write(spark, config, as_of, stamp, paths))
            except Exception as exc:
                outcome = not_made(exc)
                if outcome.status == REJECTED:
                    lake.reject_batch(spark, table, stamp, outcome.reason, paths)
                return outcome
        except Exception as exc:  # storage: the inputs or the log cannot be read or written
            return Outcome(FAILED, reason=f"{type(exc).__name__}: {exc}"[:2000])


JOINS = (
    Step("silver", "customer_policies", ("clean_customers", "clean_policies"), silver.customer_policies),
    Step("silver", "policy_claims", ("clean_policies", "clean_claims"), silver.policy_claims),
)
MARTS = (
    Step("gold", "claims_summary", ("clean_claims",), gold.claims_summary),
    Step("gold", "premium_revenue", ("clean_policies", "clean_payments"), gold.premium_revenue),
    Step("gold", "agent_performance", ("clean_agents", "clean_policies", "clean_claims"), gold.agent_performance),
    Step("gold", "customer_risk", ("customer_policies", "policy_claims"), gold.customer_risk),
)


CLEANING = tuple(Step("silver", f"clean_{t}", (t,), lambda df, as_of, t=t: silver.clean(t, df, as_of), "bronze")
                 for t in TABLES)


def run_dag(needs: dict[str, set[str]], tasks: dict[str, Callable[[], Outcome]], at_once: int = AT_ONCE) -> dict[str, Outcome]:
    """Run each task as soon as those that it needs have ended; what needs a broken one is blocked."""
    outcomes: dict[str, Outcome] = {}
    running: dict[Future, str] = {}
    left = list(tasks)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        while left or running:
            for name in [n for n in left if needs[n] <= outcomes.keys()]:
                left.remove(name)
                broken = sorted(n for n in needs[name] if outcomes[n].status in BROKEN)
                if broken:
                    outcomes[name] = Outcome(BLOCKED, reason=", ".join(broken))
                else:
                    running[pool.submit(tasks[name])] = name
            ready = any(needs[n] <= outcomes.keys() for n in left)
            if not running and not ready and left:
                raise ValueError(f"steps that wait for each other or for none of these: {left}")
            if running and not ready:
                for done in wait(running, return_when=FIRST_COMPLETED).done:
                    outcomes[running.pop(done)] = done.result()
    return {name: outcomes[name] for name in tasks}


def run_steps(spark: SparkSession, config: LakeConfig, steps: Iterable[Step], as_of: str, stamp: str,
              again: bool = True) -> dict[str, Outcome]:
    """All steps by their dependencies among each other. ``again=False``: only those whose inputs have moved on."""
    steps = list(steps)
    names = {s.name for s in steps}
    return run_dag({s.name: names.intersection(s.inputs) for s in steps},
                   {s.name: lambda s=s: s.attempt(spark, config, as_of, stamp, again) for s in steps})


def run_bronze(sources: dict[str, DataFrame], config: LakeConfig, as_of: str, stamp: str) -> dict[str, str]:
    """Land each source as a bronze batch; raises when all have ended, if one could not be."""
    def land(table: str, df: DataFrame) -> Outcome:
        try:
            return Outcome(MADE, lake.save(ingest(df, table, as_of), config, "bronze", table, stamp))
        except Exception as exc:
            return not_made(exc)
    return _paths(run_dag({t: set() for t in sources}, {t: lambda t=t, df=df: land(t, df) for t, df in sources.items()}))


def _paths(outcomes: dict[str, Outcome]) -> dict[str, str]:
    """Paths of what was made; raises if something was not."""
    if any(o.status != MADE for o in outcomes.values()):
        raise IncompleteRun(outcomes)
    return {n: o.path for n, o in outcomes.items()}


def clean_table(spark: SparkSession, config: LakeConfig, table: str, as_of: str, stamp: str) -> str:
    """C1-C6 from the latest bronze batch."""
    return next(s for s in CLEANING if s.inputs == (table,)).run(spark, config, as_of, stamp)


def run_layers(spark: SparkSession, config: LakeConfig, sources: dict[str, DataFrame] | None = None,
               layers: tuple[str, ...] = LAYERS, as_of: str | None = None, stamp: str | None = None) -> dict:
    """Run the named layers, {layer: {table: path}}. Whatever can be made is; then IncompleteRun is raised if something
    could not, with the outcome of every step. A layer that is not named is read as it is."""
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    as_of = as_of or lake.iso_now()
    stamp = stamp or lake.new_stamp()
    needs: dict[str, set[str]] = {}
    tasks: dict[str, Callable[[], Outcome]] = {}
    layer_of: dict[str, str] = {}
    if "bronze" in layers:
        if not sources:
            raise ValueError("the bronze layer needs source DataFrames")

        def land(table: str, df: DataFrame) -> Outcome:
            try:
                return Outcome(MADE, run_bronze({table: df}, config, as_of, stamp)[table])
            except IncompleteRun as exc:
                return exc.outcomes[table]
        for t, df in sources.items():
            layer_of[t], needs[t], tasks[t] = "bronze", set(), lambda t=t, df=df: land(t, df)
    steps = [*(CLEANING + JOINS if "silver" in layers else ()), *(MARTS if "gold" in layers else ())]
    for s in steps:
        layer_of[s.name] = s.layer
        tasks[s.name] = lambda s=s: s.attempt(spark, config, as_of, stamp, True)
    for s in steps:
        needs[s.name] = set(s.inputs) & tasks.keys()
    outcomes = run_dag(needs, tasks)
    if any(o.status != MADE for o in outcomes.values()):
        raise IncompleteRun(outcomes)
    return {layer: {n: o.path for n, o in outcomes.items() if layer_of[n] == layer} for layer in LAYERS if layer in layers}
