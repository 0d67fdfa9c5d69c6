"""The document readers as SQL table functions, for use without Python.

``register_sql_functions`` makes temporary functions of the session.  Their
bodies are SQL, so the planner sees through them.  Each has one generator only:
Spark turns a lateral join over one into that generator on the row, but a
lateral join over several in a row into a join of all documents with their
rows on the whole text.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .. import schemas as S


def _ddl(kind: T.DataType) -> str:
    return kind.simpleString()


def sql_functions() -> dict[str, str]:
    """Name of each table function and the statement that makes it."""
    return {
        "tab_propositions": f"""
            CREATE OR REPLACE TEMPORARY FUNCTION tab_propositions(body STRING)
            RETURNS TABLE (match_pos INT, match STRING, start_time STRING, market_pos INT, market_name STRING,
                           prop_pos INT, prop_id BIGINT, prop_name STRING, price DOUBLE)
            RETURN SELECT r.* FROM LATERAL inline(flatten(transform(
                from_json(tab_propositions.body, '{_ddl(S.TAB_RESPONSE)}').matches, (m, i) ->
                flatten(transform(coalesce(m.markets, array()), (k, j) ->
                transform(coalesce(k.propositions, array()), (p, n) ->
                    named_struct('match_pos', i, 'match', m.name, 'start_time', m.startTime, 'market_pos', j, 'market_name', k.betOption,
                                 'prop_pos', n, 'prop_id', p.id, 'prop_name', p.name, 'price', p.returnWin))))))) AS r""",
        "sportsbet_propositions": f"""
            CREATE OR REPLACE TEMPORARY FUNCTION sportsbet_propositions(body STRING)
            RETURNS TABLE (market_pos INT, market_name STRING, market_id BIGINT, prop_pos INT, prop_id BIGINT,
                           prop_name STRING, result_type STRING, price DOUBLE, handicap DOUBLE)
            RETURN SELECT r.* FROM LATERAL inline(flatten(transform(
                from_json(sportsbet_propositions.body, '{_ddl(S.SB_MARKETS_RESPONSE)}'), (k, j) ->
                transform(coalesce(k.selections, array()), (p, n) ->
                    named_struct('market_pos', j, 'market_name', k.name, 'market_id', k.externalId, 'prop_pos', n, 'prop_id', p.externalId,
                                 'prop_name', p.name, 'result_type', p.resultType, 'price', p.price.winPrice,
                                 'handicap', try_cast(p.unformattedHandicap AS DOUBLE)))))) AS r""",
        "request_urls": """
            CREATE OR REPLACE TEMPORARY FUNCTION request_urls(base STRING, match_id BIGINT)
            RETURNS TABLE (endpoint STRING, url STRING)
            RETURN SELECT e.one.endpoint, concat(request_urls.base, '/Events/', request_urls.match_id, '/', e.one.path)
            FROM LATERAL explode(array(""" + ", ".join(
                f"named_struct('endpoint', '{name}', 'path', '{path}')" for name, path in _endpoints().items()) + ")) AS e(one)",
    }


def _endpoints() -> dict[str, str]:
    from ..sources.manifest import EVENT_ENDPOINTS

    return dict(EVENT_ENDPOINTS)


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the table functions in this session; returns their names."""
    made = sql_functions()
    for statement in made.values():
        spark.sql(statement)
    return list(made)
