"""What a read-only statement may reach, decided on its plans and not on its text.

``check_parsed`` walks the parsed statement before anything is resolved: no command, no IDENTIFIER clause
(analysis would evaluate its argument), only functions on the list, only relations that are known.
``check_resolved`` walks the analysed plan, subqueries and WITH parts included: every operator and every
expression class must be on a list, and every leaf must be one of the views' own files, rows written
in the statement, or a WITH part that is walked itself.  Whatever is not listed is refused, so a new
function or operator of the engine is closed until someone opens it.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

from pyspark.sql import DataFrame, SparkSession


class StatementRefused(ValueError):
    """The statement is not a single read-only query over the views."""


# Functions that read their arguments only and make no more rows or bytes than they are given.
FUNCTIONS = frozenset("""
abs acos acosh add_months aggregate any any_value approx_count_distinct approx_percentile array array_agg array_contains array_distinct
array_except array_intersect array_join array_max array_min array_position array_remove array_size array_sort array_union
ascii asin asinh atan atan2 atanh avg between bigint bin bit_and bit_count bit_length bit_or bit_xor bool_and bool_or boolean
bround btrim cardinality cast cbrt ceil ceiling char_length character_length coalesce collect_list collect_set concat
concat_ws contains corr cos cosh cot count count_if covar_pop covar_samp cume_dist current_date current_timestamp date
date_add date_diff date_format date_from_unix_date date_part date_sub date_trunc dateadd datediff day dayname dayofmonth dayofweek
dayofyear decimal degrees dense_rank div double element_at elt endswith every exists exp explode explode_outer expm1 extract
factorial filter find_in_set first first_value flatten float floor forall format_number format_string from_unixtime
get greatest grouping grouping_id hash hex histogram_numeric hour hypot if ifnull in initcap inline inline_outer instr int isnan isnotnull isnull
kurtosis lag last last_day last_value lcase lead least left len length levenshtein like listagg ln locate log log10 log1p log2 lower ltrim
make_date make_timestamp map map_keys map_values max max_by md5 mean median min min_by minute mod mode month monthname months_between
named_struct nanvl negative next_day not now nth_value ntile nullif nullifzero nvl nvl2 octet_length overlay percent_rank percentile
percentile_approx percentile_cont percentile_disc pmod posexplode posexplode_outer position positive pow power printf quarter radians
rank reduce regexp regexp_count regexp_extract regexp_extract_all regexp_instr regexp_like regexp_replace regexp_substr replace
reverse right rint rlike round row_number rtrim second sha1 sha2 shiftleft shiftright sign signum sin sinh size skewness slice smallint some
sort_array split split_part sqrt stack startswith std stddev stddev_pop stddev_samp string string_agg struct substr substring substring_index
sum tan tanh timestamp tinyint to_char to_date to_number to_timestamp to_unix_timestamp transform
translate trim trunc try_add try_avg try_divide try_element_at try_multiply try_subtract try_sum try_to_number try_to_timestamp
typeof ucase unhex unix_date unix_timestamp upper var_pop var_samp variance weekday weekofyear width_bucket xxhash64 year zeroifnull zip_with
""".split())

# Table functions; all others, and those that make rows of nothing, are refused.
TABLE_FUNCTIONS = frozenset({"explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack"})

_OPERATORS = frozenset("""
Aggregate CTERelationDef CTERelationRef Distinct Except Expand Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit
LocalRelation LogicalRelation Offset OneRowRelation Project ResolvedHint Sample Sort SubqueryAlias Union View Window WithCTE
""".split())

# Operators of parsed plans only.
_PARSED = _OPERATORS | {"UnresolvedWith", "UnresolvedHint", "UnresolvedHaving", "Pivot", "Unpivot", "NamedParametersQuery", "WithWindowDefinition",
                        "UsingJoin", "Deduplicate"}

# Parts of expressions that no function names: references, literals, operators, predicates, windows, subqueries.
_PARTS = frozenset("""
Add AggregateExpression Alias And AttributeReference BinaryArithmetic BitwiseAnd BitwiseNot BitwiseOr BitwiseXor CaseWhen Cast Contains
CreateArray CreateNamedStruct DateAddInterval DateFormatClass DatetimeSub Divide EndsWith EqualNullSafe EqualTo EvalMode Exists ExtractANSIIntervalDays
FrameLessOffsetWindowFunction GetArrayItem GetArrayStructFields GetMapValue GetStructField GreaterThan GreaterThanOrEqual Grouping GroupingID
ILike If In InSet InSubquery IntegralDivide IsNotNull IsNull LambdaFunction LateralSubquery LessThan LessThanOrEqual Like LikeAll LikeAny ListQuery
Literal MakeDecimal Multiply NamedLambdaVariable Not NotLikeAll NotLikeAny Or OuterReference PrettyAttribute RLike Remainder RoundCeil RoundFloor
RowFrame RangeFrame ScalarSubquery SortOrder SpecifiedWindowFrame SpecialFrameBoundary StartsWith SubtractDates SubtractTimestamps Subtract TempResolvedColumn
TimeAdd TimestampAddInterval TryEval UnaryMinus UnaryPositive UnscaledValue UpCast WindowExpression WindowSpecDefinition
Between Ceil CommonExpressionDef CommonExpressionRef DateAddYMInterval DatePart EulerNumber Explode Extract Floor GeneratorOuter Hour HoursOfTime Inline Invoke MakeTimestamp
Minute MinutesOfTime Mode PercentileCont PercentileDisc PivotFirst PosExplode Second SecondWithFraction SecondsOfTime Stack StaticInvoke
StringTrim StringTrimBoth StringTrimLeft StringTrimRight ToCharacter TimestampAdd TimestampAddYMInterval TimestampDiff
TypedNullLiteral With CurrentRow$ UnboundedPreceding$ UnboundedFollowing$ RowFrame$ RangeFrame$ CurrentDate CurrentTimestamp
""".split())
_WITH_PLAN = frozenset({"ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"})
_PACKAGES = ("org.apache.spark.sql.catalyst.", "org.apache.spark.sql.execution.datasources.LogicalRelation")


def refuse(reason: str) -> None:
    raise StatementRefused(f"Query rejected for safety: {reason}")


def _items(seq) -> Iterator:
    for i in range(seq.size()):
        yield seq.apply(i)


def _class(node) -> str:
    name = node.getClass().getName()
    if not name.startswith(_PACKAGES):
        refuse(f"{name.rsplit('.', 1)[-1]} is not available")
    return name.rsplit(".", 1)[-1]


def _plan_test(session: SparkSession):
    """Whether a node of a plan is an operator rather than an expression."""
    loader = session._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    return loader.loadClass("org.apache.spark.sql.catalyst.plans.QueryPlan").isInstance


def parsed(session: SparkSession, sql: str):
    try:
        return session._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as error:
        raise StatementRefused("Query rejected for safety: it cannot be parsed") from error


def _parsed_nodes(session: SparkSession, plan) -> Iterator[tuple[str, object]]:
    """(class, node) of operators and expressions as parsed, subqueries and WITH parts included."""
    is_plan, stack = _plan_test(session), [plan]
    while stack:
        node = stack.pop()
        name = node.getClass().getName().rsplit(".", 1)[-1]
        yield name, node
        stack += _items(node.children())
        if is_plan(node):
            stack += _items(node.expressions())
        if name == "UnresolvedWith":
            stack += [pair._2() for pair in _items(node.cteRelations())]
        elif name in _WITH_PLAN:
            stack.append(node.plan())
        elif name == "InSubquery":
            stack.append(node.query())


def check_parsed(session: SparkSession, sql: str, known: Collection[str]) -> None:
    """Refuse what must not even be resolved."""
    plan = parsed(session, sql)
    relations, own = [], set()
    for name, node in _parsed_nodes(session, plan):
        if "Command" in name or ".plans.logical." in node.getClass().getName() and name not in _PARSED:
            refuse(f"{name} is not available")
        if "UnresolvedIdentifier" in name:
            refuse("IDENTIFIER is not available")
        if name == "UnresolvedRelation":
            relations.append(list(_items(node.multipartIdentifier())))
        elif name == "UnresolvedWith":
            own |= {pair._1().lower() for pair in _items(node.cteRelations())}
        elif name in ("UnresolvedFunction", "UnresolvedGenerator", "UnresolvedTableValuedFunction"):
            called = list(_items(node.name() if name == "UnresolvedTableValuedFunction" else node.nameParts())) if name != "UnresolvedGenerator" \
                else [node.name().funcName()]
            listed = TABLE_FUNCTIONS if name == "UnresolvedTableValuedFunction" else FUNCTIONS
            if len(called) != 1 or called[0].lower() not in listed:
                refuse(f"function {'.'.join(called)} is not available")
    for parts in relations:
        name = ".".join(parts).lower()
        # A WITH name is its own only if no table stands behind it.
        if name not in known and (len(parts) != 1 or name not in own or session.catalog.tableExists(name)):
            refuse(f"unknown relation {'.'.join(parts)}")


def location(leaf) -> str:
    """Root paths of a file relation."""
    relation = leaf.relation()
    if relation.getClass().getName() != "org.apache.spark.sql.execution.datasources.HadoopFsRelation":
        refuse("only files of the views are available")
    return relation.location().rootPaths().mkString("\n")


def locations(df: DataFrame) -> set[str]:
    """Of the file relations below a view's own rows."""
    return {location(leaf) for leaf in _items(df._jdf.queryExecution().analyzed().collectLeaves())}


_listed: frozenset[str] | None = None


def _expressions(session: SparkSession) -> frozenset[str]:
    """Expression classes that a statement may hold; the built-in ones are the same in every session."""
    global _listed
    if _listed is None:
        registry = session._jsparkSession.sessionState().functionRegistry()
        identifier = session._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
        known = (registry.lookupFunction(identifier(name)) for name in FUNCTIONS)
        _listed = _PARTS | {info.get().getClassName().rsplit(".", 1)[-1] for info in known if info.isDefined()}
    return _listed


def check_resolved(session: SparkSession, df: DataFrame, allowed: Collection[str]) -> None:
    """Refuse a plan with an operator, expression or leaf that is not listed; nothing has run yet."""
    plans, expressions = [df._jdf.queryExecution().analyzed()], []
    listed = _expressions(session)
    while plans or expressions:
        if plans:
            node = plans.pop()
            name = _class(node)
            if name not in _OPERATORS:
                refuse(f"{name} is not available")
            if name == "LogicalRelation" and location(node) not in allowed:
                refuse("only files of the views are available")
            plans += _items(node.children())
            expressions += _items(node.expressions())
            continue
        node = expressions.pop()
        name = _class(node)
        if name in _WITH_PLAN:
            plans.append(node.plan())
        elif name not in listed:
            refuse(f"{name} is not available")
        expressions += _items(node.children())
