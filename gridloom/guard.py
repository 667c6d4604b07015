"""Which SQL statements a caller may run, by the plan that Spark's own parser makes of them.

A plan may consist of the nodes named here and no others, so what a later
version of Spark adds is refused until it is listed.  Relations must be views
or tables of the catalogue or names of the statement's own; functions must not
reach beyond their arguments.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import ParseException
from pyspark.sql import SparkSession

#: Nodes of a statement that returns rows.
QUERY = set(
    """Project Filter Aggregate Join LateralJoin AsOfJoin Sort GlobalLimit LocalLimit Tail Offset Union Intersect Except
    Distinct Deduplicate SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedWith CTERelationDef CTERelationRef
    UnresolvedRelation UnresolvedInlineTable LocalRelation OneRowRelation OneRowRelation$ Range UnresolvedHaving
    WithWindowDefinition Generate Expand Pivot Unpivot Sample UnresolvedHint PipeOperator Window
    UnresolvedTableValuedFunction UnresolvedTVFAliases""".split()
)
#: Statements that describe, and those that make a temporary view or set a variable of the session.
SHOWING = {"DescribeRelation", "DescribeColumn", "DescribeQueryCommand", "DescribeFunction", "ExplainCommand", "ShowTables", "ShowViews", "ShowColumns", "ShowFunctions", "ShowNamespacesCommand"}
MAKING = {"CreateViewCommand", "SetVariable", "CreateVariable"}
#: What only stands below those.
PARTS = {"UnresolvedTableOrView", "UnresolvedTable", "UnresolvedNamespace", "CurrentNamespace$", "UnresolvedIdentifier", "UnresolvedFunctionName", "DefaultValueExpression"}
#: Functions that call the JVM, and those that say where data lies.
UNSAFE_FUNCTIONS = {"reflect", "java_method", "try_reflect", "input_file_name", "input_file_block_start", "input_file_block_length"}
TABLE_FUNCTIONS = {
    "read_geo", "plan_read_geo", "read_zarr_metadata", "range", "explode", "explode_outer", "posexplode", "posexplode_outer",
    "inline", "inline_outer", "stack", "json_tuple", "variant_explode", "variant_explode_outer", "sql_keywords", "collations",
}
TEMPORARY_TABLE = re.compile(r"^(\s*create\s+(?:or\s+replace\s+)?temp(?:orary)?)\s+table\b", re.I)


class Rejected(ValueError):
    pass


@dataclass(frozen=True)
class Statement:
    text: str
    #: Whether it gives rows; else it only changes the session.
    reads: bool


def items(seq) -> list:
    return [seq.apply(k) for k in range(seq.size())]


def nodes(node) -> Iterator[tuple[str, object, bool]]:
    """Class, node, and whether it is a plan (else an expression) of all that a plan holds, subqueries included."""
    todo = [(node, True)]
    while todo:
        node, plan = todo.pop()
        name = node.getClass().getSimpleName()
        yield name, node, plan
        todo += [(c, plan) for c in items(node.children())]
        if not plan:
            # A subquery's plan is also an inner child of the plan that it stands in, but not within a window's definition.
            todo += [(node.plan(), True)] if name in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery") else []
            continue
        todo += [(c, True) for c in items(node.innerChildren()) if hasattr(c, "innerChildren")]
        todo += [(e, False) for e in items(node.expressions())]
        if name == "ExplainCommand":
            todo.append((node.logicalPlan(), True))
        elif name == "DescribeQueryCommand":
            todo.append((node.plan(), True))
        elif name == "WithWindowDefinition":
            todo += [(w, False) for w in items(node.windowDefinitions().values().toSeq())]


def names(parts) -> list[str]:
    return [str(p) for p in items(parts)]


def check(sql: str, spark: SparkSession | None = None) -> Statement:
    """The statement, if it may run."""
    spark = spark or SparkSession.active()
    # Temporary tables are views here.
    text = TEMPORARY_TABLE.sub(r"\1 view", sql.strip().rstrip(";").strip())
    if not text:
        raise Rejected("the statement is empty")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException as e:
        raise Rejected(f"the statement can't be parsed: {e.getMessage()}") from e
    top = plan.getClass().getSimpleName()
    if top not in QUERY | SHOWING | MAKING:
        raise Rejected(f"{top} isn't a statement that may run")
    found = list(nodes(plan))
    for name, node, is_plan in found:
        if is_plan and node is not plan and name not in QUERY | PARTS:
            raise Rejected(f"{name} may not be part of a statement")
        if name in ("UnresolvedRelation", "UnresolvedTableOrView"):
            relation(spark, names(node.multipartIdentifier()))
        elif name == "CreateViewCommand":
            if node.viewType().getClass().getSimpleName() == "PersistedView$":
                raise Rejected("only temporary views and tables may be created")
        elif name == "UnresolvedFunction" and names(node.nameParts())[-1].lower() in UNSAFE_FUNCTIONS:
            raise Rejected(f"{names(node.nameParts())[-1]} may not be called")
        elif name == "UnresolvedGenerator" and node.name().funcName().lower() not in TABLE_FUNCTIONS:
            raise Rejected(f"{node.name().funcName()} may not be called")
        elif name == "UnresolvedTableValuedFunction" and names(node.name())[-1].lower() not in TABLE_FUNCTIONS:
            raise Rejected(f"{names(node.name())[-1]} isn't a table function that may be called")
    return Statement(text, top not in MAKING)


def relation(spark: SparkSession, name: list[str]) -> None:
    """Refuse what isn't in the catalogue if it could be a path: a name of several parts."""
    if len(name) == 1:
        return
    if not spark.catalog.databaseExists(".".join(f"`{p.replace('`', '``')}`" for p in name[:-1])):
        raise Rejected("files may not be read by their path: there is no such database")
