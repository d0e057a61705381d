"""A title catalogue derived from the star-schema tables, in SQL both engines run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fingerprint, stage_once

_GENRES = "'Action,Comedy,Drama,Crime,Horror,Sci-Fi,Romance,Family'"
_ROLES = "'actor,Actress,director,writer,producer,cinematographer,composer,editor,self,archive_footage'"


def _id(prefix: str, expr: str, width: int) -> str:
    return f"'{prefix}'||lpad(cast({expr} as string),{width},'0')"


def _tt(expr: str) -> str:
    return _id("tt", expr, 9)


def _nm(expr: str) -> str:
    return _id("nm", expr, 7)


def _genre(shift: int) -> str:
    return f"split_part({_GENRES},',',cast((o_orderkey+{shift})%8 as int)+1)"


CATALOGUE_SQL = {
    "raw_title_basics": f"""
select {_tt('o_orderkey')} as tconst,
 case o_orderstatus when 'F' then 'movie' when 'O' then 'tvSeries' else 'tvEpisode' end as titleType,
 case when o_orderkey%17=0 then '' when o_orderstatus='P' and o_orderkey%2=0
  then 'Episode #'||cast(o_orderkey%9+1 as string)||'.'||cast(o_orderkey%30+1 as string)
  else o_orderpriority||' '||cast(o_orderkey as string) end as primaryTitle,
 case when o_orderkey%19=0 then '' else o_orderpriority end as originalTitle,
 case when o_orderkey%23=0 then '1' when o_orderkey%29=0 then 'x' else '0' end as isAdult,
 case when o_orderkey%31=0 then null else cast(1900+o_orderkey%135 as int) end as startYear,
 case when o_orderstatus='O' and o_orderkey%2=0 then cast(1900+o_orderkey%135+o_orderkey%25 as int) end as endYear,
 case when o_orderkey%37=0 then null else cast(o_orderkey%240 as int) end as runtimeMinutes,
 case when o_orderkey%41=0 then null when o_orderkey%3=0 then g1
  when o_orderkey%3=1 then g1||','||g2 else g1||','||g2||','||g3 end as genres
from (select o.*, {_genre(0)} as g1, {_genre(3)} as g2, {_genre(5)} as g3 from orders o) x""",
    "raw_title_ratings": f"""
select {_tt('o_orderkey')} as tconst, cast(floor(100.5-((o_orderkey*7919)%91)*((o_orderkey*7919)%91)/90.0)/10.0 as decimal(3,1)) as averageRating,
 cast(floor(o_totalprice/(1+o_orderkey%97)) as int) as numVotes
from orders where o_orderkey%5<>0""",
    "raw_name_basics": f"""
select {_nm('s_suppkey')} as nconst, case when s_suppkey%11=0 then '' else s_name end as primaryName,
 case when s_suppkey%4=0 then null else cast(1790+s_suppkey%200 as int) end as birthYear,
 case when s_suppkey%6=1 then cast(1790+s_suppkey%200+60 as int) end as deathYear,
 case when s_suppkey%7=0 then null when s_suppkey%2=0 then 'actor,director' else 'writer,producer,editor' end as primaryProfession,
 case when s_suppkey%5=0 then null else {_tt('s_suppkey')}||','||{_tt('s_suppkey+1')} end as knownForTitles
from supplier""",
    "raw_title_crew": f"""
select {_tt('l_orderkey')} as tconst,
 case when min(l_suppkey)=max(l_suppkey) then {_nm('min(l_suppkey)')}
  else {_nm('max(l_suppkey)')}||', '||{_nm('min(l_suppkey)')} end as directors,
 case when l_orderkey%3=0 then null when l_orderkey%3=1 then '' else {_nm('min(l_suppkey)')}||',' end as writers
from lineitem group by l_orderkey""",
    "raw_title_episode": f"""
select {_tt('o_orderkey')} as tconst, {_tt('pk')} as parentTconst,
 case when o_orderkey%13=0 then null else cast(o_orderkey%6+1 as int) end as seasonNumber,
 case when o_orderkey%14=0 then null else cast(o_orderkey%24+1 as int) end as episodeNumber
from orders o join (select o_custkey as ck, min(o_orderkey) as pk from orders where o_orderstatus='O' group by o_custkey) p
 on o.o_custkey=p.ck where o_orderstatus='P'""",
    "raw_title_principals": f"""
select {_tt('l_orderkey')} as tconst, l_linenumber as ordering, {_nm('l_suppkey')} as nconst,
 split_part({_ROLES},',',cast(l_partkey%10 as int)+1) as category,
 case when l_partkey%4=0 then null else l_returnflag end as job,
 case when l_partkey%3=0 then null else l_linestatus end as characters
from lineitem""",
}


SOURCES = ["orders", "lineitem", "supplier"]


def register_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def spread(rows: DataFrame) -> DataFrame:
    """The rows of a source, dealt out when its row groups would keep few of the cores busy.

    Rows per task are told by the files' footers, no column is read.
    """
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    held = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    most, total = held.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return rows.repartition(tasks) if most * tasks > 2 * total else rows


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw extract as a lazy query over the star-schema tables.

    The sources are spread out before their texts are built: the columns are fewer and narrower then.
    """
    sql = CATALOGUE_SQL[name]
    read = [t for t in SOURCES if re.search(rf"\b{t}\b", sql)]
    named = {t: spread(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in read}
    return spark.sql(re.sub(rf"\b({'|'.join(read)})\b", r"{\1}", sql), **named)


def sources_of(spark: SparkSession, sf_dir: str) -> str:
    """A digest of the source files' names, sizes and times: part of the key of what is stored from them."""
    return fingerprint(spark, *(f"{sf_dir}/{t}.parquet" for t in SOURCES))


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw extract as a loaded table, written once per session and state of the source files."""
    return stage_once(spark, (sf_dir, sources_of(spark, sf_dir), name), lambda: derived(spark, sf_dir, name))
