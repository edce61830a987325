"""Ad-hoc queries over the corpus tables: read only, one statement, a ceiling of rows."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

from nomograph.functions import tables
from nomograph.plans.config import TIMEOUT_MS, entry_point
from nomograph.plans.errors import RequestError
from nomograph.plans.requests import CEILING
from nomograph.sources.corpus import Corpus

#: Nodes of parsed plans that only read. What isn't named here is refused.
READING = frozenset(
    "Aggregate AsOfJoin Distinct Except Expand Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit LocalRelation Offset OneRowRelation PipeOperator Pivot Project Range Sample Sort SubqueryAlias "
    "Tail Union UnresolvedHaving UnresolvedInlineTable UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedTableValuedFunction UnresolvedTVFAliases UnresolvedWith Unpivot Window WithCTE WithWindowDefinition".split()
)
#: Functions that run any method of the JVM, and what they are once resolved.
CALLING = frozenset(("reflect", "java_method", "try_reflect"))
CALLS = frozenset(("CallMethodViaReflection", "TryReflect"))
#: Table functions that only compute: Spark's, and the corpus's own.
TABLE_FUNCTIONS = frozenset("range explode explode_outer posexplode posexplode_outer inline inline_outer stack json_tuple variant_explode variant_explode_outer".split()) | set(tables.FUNCTIONS)
LEAST_TEXT = 10


def _parsed(spark: SparkSession, statement: str):
    try:
        return spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    except PySparkException as e:
        raise RequestError("query_error", str(e).strip().splitlines()[0]) from None


def _reads(plan) -> bool:
    """Whether the plan and all plans below it, those of WITH clauses and subqueries included, only read."""
    if plan.nodeName() not in READING or not all(_harmless(e) for e in _seq(plan.expressions())):
        return False
    if plan.nodeName() == "UnresolvedTableValuedFunction" and [str(n).lower() for n in _seq(plan.name())][-1] not in TABLE_FUNCTIONS:
        return False
    return all(_reads(p) for p in (*_seq(plan.children()), *_seq(plan.innerChildren())))


def _seq(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _harmless(expression) -> bool:
    """Whether all functions in the expression are named plainly, by names that call nothing else. What IDENTIFIER(...) names isn't known before it is run."""
    kind = expression.getClass().getSimpleName()
    if "UnresolvedIdentifier" in kind or kind.startswith("Parameter") or kind.endswith("Parameter"):
        return False
    if kind == "UnresolvedFunction" and str(_seq(expression.nameParts())[-1]).lower() in CALLING:
        return False
    return all(_harmless(e) for e in _seq(expression.children()))


def _resolved(plan) -> bool:
    """Whether no expression of an analysed statement calls the JVM, whatever name it came by. The corpus's own tables aren't looked into."""
    if plan.nodeName() == "View":
        return True
    calls = [plan.expressions()]
    while calls:
        for e in _seq(calls.pop()):
            if e.getClass().getSimpleName() in CALLS:
                return False
            calls.append(e.children())
    return all(_resolved(p) for p in (*_seq(plan.children()), *_seq(plan.innerChildren())))


def read_only(spark: SparkSession, statement: str) -> bool:
    """Whether the statement parses to a query; raises query_error if it doesn't parse."""
    return _reads(_parsed(spark, statement))


def _own_limit(spark: SparkSession, statement: str) -> int | None:
    """The literal limit of the outermost clause; limits inside don't count."""
    plan = _parsed(spark, statement)
    if plan.nodeName() == "UnresolvedWith":
        plan = plan.children().apply(0)
    if plan.nodeName() != "GlobalLimit":
        return None
    limit = plan.limitExpr()
    return int(str(limit)) if str(limit).isdigit() else None


@dataclass
class Bounded:
    df: DataFrame
    limit_enforced: bool


def select(corpus: Corpus, statement: str, ceiling: int = CEILING) -> Bounded:
    """The statement's rows up to the ceiling; limit_enforced if the ceiling changed the query."""
    spark = corpus.spark
    if len(statement.strip()) < LEAST_TEXT:
        raise RequestError("invalid_argument", "The statement is too short.")
    if not read_only(spark, statement):
        raise RequestError("not_read_only", "The statement isn't a query.")
    own = _own_limit(spark, statement)
    # a session of its own: its views and its setting, which keeps statements from reading files by path, touch no other
    session = spark.newSession()
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    tables.register(session)
    of_rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows
    for name in corpus.tables():
        DataFrame(of_rows(session._jsparkSession, corpus[name]._jdf.queryExecution().analyzed()), session).createOrReplaceTempView(name)
    try:
        df = session.sql(statement)
        df.schema  # noqa: B018  analysis happens here
    except AnalysisException as e:
        raise RequestError("query_error", str(e).strip().splitlines()[0]) from None
    if not _resolved(df._jdf.queryExecution().analyzed()):
        raise RequestError("not_read_only", "The statement calls what isn't a query's to call.")
    changed = own is None or own > ceiling
    return Bounded(df.limit(ceiling) if changed else df, changed)


@dataclass
class Answer:
    variables: list[str]
    bindings: list[Row]
    truncated: bool


@entry_point("adhoc")
def run(corpus: Corpus, statement: str, timeout_ms: int | None = None, ceiling: int | None = None) -> Answer:
    """The eager form, with a time limit: the running job is cancelled. Limits not given are those of the corpus's settings."""
    timeout_ms = corpus.settings.timeout_ms if timeout_ms is None else timeout_ms
    ceiling = corpus.settings.row_ceiling if ceiling is None else ceiling
    if not TIMEOUT_MS[0] <= timeout_ms <= TIMEOUT_MS[1]:
        raise RequestError("invalid_argument", f"The timeout must be from {TIMEOUT_MS[0]} to {TIMEOUT_MS[1]} ms.")
    bounded, sc = select(corpus, statement, ceiling), corpus.spark.sparkContext
    tag, late, done = f"adhoc-{id(bounded)}", threading.Event(), threading.Event()

    def stop() -> None:
        if not done.wait(timeout_ms / 1000):
            late.set()
            sc.cancelJobsWithTag(tag)
        while not done.wait(0.2):  # a job that starts only now, or a further one of the same query
            sc.cancelJobsWithTag(tag)

    sc.addJobTag(tag)
    threading.Thread(target=stop, daemon=True).start()
    try:
        rows = bounded.df.collect()
    except (PySparkException, Py4JError) as e:  # a cancelled job comes as the latter
        raise RequestError("query_timeout" if late.is_set() else "query_error", str(e).strip().splitlines()[0]) from None
    finally:
        done.set()
        sc.removeJobTag(tag)
    return Answer(bounded.df.columns, rows, bounded.limit_enforced and len(rows) == ceiling)
