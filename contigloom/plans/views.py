"""Tables of this domain derived from the driver's tables, one SQL text for Spark and DuckDB.

``{name}`` stands for a table. ``DNA``/``QUAL`` spell text as bases or qualities; their regular expression
replaces every match in Spark and needs a flag for that in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Letter maps.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "ACGTNACGTACGTACGTACGTACGTA"
QUALITIES = "0123456789:;<=>?@ABCDEFGHI"


def _spell(column: str, target: str, flag: str) -> str:
    return f"translate(regexp_replace(lower({column}), '[^a-z]', ''{flag}), '{LETTERS}', '{target}')"


def _view_sql(flag: str) -> dict[str, str]:
    dna, qual = _spell("text", BASES, flag), _spell("text", QUALITIES, flag)
    return {
        "contigs_v": f"""
select source as sample, concat('/in/', source, '.fasta') as path, 'before' as stage, doc_id as rec_no,
  case when doc_id%100>=80 then concat('scaffold_',doc_id)
       when doc_id%100>=60 then concat('NODE_',doc_id,'_length_',n_chars,'_depth_',cov,'.',doc_id%10)
       else concat('NODE_',doc_id,'_length_',n_chars,'_cov_',cov,'.',doc_id%10) end as header, seq
from (select *, case when source='src7' then doc_id%10 else (doc_id*37)%61 end as cov,
             {dna} as seq from {{documents}}) d""",
        "reads_v": f"""
select concat('C',conv_id%8) as sample, conv_id*1000000+cast((turn-turn%2)/2 as bigint) as read_no, cast(turn%2+1 as int) as mate,
       {dna} as seq, {qual} as qual from {{conversations}}""",
        "read_names_v": """
select concat('S',c_custkey, case c_custkey%3 when 0 then '_R1_001.fastq.gz' when 1 then '.1.fq' else '-R1.fastq' end) as name from {customer}
union all
select concat('S',c_custkey, case c_custkey%3 when 0 then '_R2_001.fastq.gz' when 1 then '.2.fq' else '-R2.fastq' end) as name from {customer} where c_custkey%10<>0""",
        "hits_v": """
select case when l_suppkey=0 then '/out/before.fasta'
            when l_linenumber%2=0 then concat('/out/S',l_suppkey,'_filtered.fasta')
            else concat('/out/S',l_suppkey,'.fasta') end as file,
  p_brand as gene, concat('db_',l_returnflag) as database,
  case when p_size%7=0 then '' else p_type end as resistance,
  cast(l_quantity as int)+50 as pct_identity, p_size+50 as pct_coverage
from {lineitem} join {part} on l_partkey=p_partkey""",
        "amr_v": """
select l_linestatus as stage, concat('S',l_suppkey%50) as sample, concat(l_linestatus,'_',l_returnflag) as drug_class,
  max(case when l_suppkey%50=l_partkey%50 or l_suppkey%7=l_linenumber then '' else p_brand end) as value
from {lineitem} join {part} on l_partkey=p_partkey group by 1,2,3
union all
select l_linestatus, concat('S',l_suppkey%50), 'SHARED', max(p_brand) from {lineitem} join {part} on l_partkey=p_partkey group by 1,2""",
        "status_v": """
select concat('S',user_id) as sample,
  case event_type when 'signup' then 'FASTP' when 'view' then 'SPADES' when 'click' then 'QUAST-b' when 'purchase' then 'FILTER' else 'QUAST-a' end as step,
  case event_id%5 when 0 then '-' when 1 then 'RUNNING' when 2 then 'OK' when 3 then 'FAIL' else 'SKIPPED' end as status,
  ts, event_id as seq_no from {events}""",
        "log_lines_v": """
select concat('C',conv_id) as file, turn as line_no, text as line from {conversations}""",
        "taxonomy_v": """
select 1 as taxid, cast(null as int) as parent_taxid, 'root' as name
union all select cast(10+r_regionkey as int), 1, r_name from {region}
union all select cast(100+n_nationkey as int), cast(10+n_regionkey as int), n_name from {nation}""",
        "references_v": f"""
select cast(100+item_id%25 as int) as taxid, {dna} as seq from {{benchmark}}""",
        "skips_v": """
select case event_type when 'view' then 'spades' when 'click' then 'Quast-B' else event_type end as name
from {events}""",
    }


SPARK_VIEWS = _view_sql("")
DUCKDB_VIEWS = _view_sql(",'g'")

TABLES = {
    "contigs_v": ["documents"], "reads_v": ["conversations"], "read_names_v": ["customer"],
    "hits_v": ["lineitem", "part"], "amr_v": ["lineitem", "part"], "status_v": ["events"],
    "log_lines_v": ["conversations"], "taxonomy_v": ["region", "nation"], "references_v": ["benchmark"],
    "skips_v": ["events"],
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def views(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """A function from the name of a view to its DataFrame. The files of a table are looked up once."""
    opened: dict[str, DataFrame] = {}

    def source(t: str) -> DataFrame:
        if t not in opened:
            opened[t] = table(spark, folder, t)
        return opened[t]

    return lambda name: spark.sql(SPARK_VIEWS[name], **{t: source(t) for t in TABLES[name]})


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return views(spark, folder)(name)


def duckdb_with(sql: str) -> str:
    """``sql`` with the views it names put in front of it."""
    used = [v for v in DUCKDB_VIEWS if v in sql]
    names = {t: t for v in used for t in TABLES[v]}
    parts = [f"{v} as ({DUCKDB_VIEWS[v].format(**names)})" for v in used]
    sql = sql.strip()
    if not parts:
        return sql
    if sql.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join(parts) + ",\n" + sql[len("with recursive "):]
    if sql.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + sql[len("with "):]
    return "with " + ",\n".join(parts) + "\n" + sql
