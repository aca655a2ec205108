"""Catalog snapshots and log segments of many sources, derived from ``part`` and ``supplier``.

Each part stands for a table of its brand's catalog, and for one archived log segment of its
brand's database; suppliers give saved positions and instances.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cdcflow.workload.registry import table

# ---- segments ---------------------------------------------------------------------------------

SEGMENT_SQL = """
seg as (select p_brand source, p_size % 2 + 1 thread, p_partkey "sequence", p_partkey*100 first_change, p_partkey*100+100 next_change,
        p_brand || '/arch_' || lpad(cast(p_partkey as varchar), 12, '0') "name", p_type from part),
ranked as (select *, row_number() over (partition by source, thread order by "sequence" desc) rk from seg),
archived as (select * from seg where p_type <> 'ECONOMY'),
online as (select *, case when rk = 1 then 'CURRENT' else 'ACTIVE' end status, thread*10+rk group_no from ranked where rk <= 3),
positions as (select 'Brand#' || cast(s_nationkey+1 as varchar) source, min(s_suppkey)*1000 scn from supplier group by 1),
since as (
 select source, 'ARCH' kind, thread, "sequence", first_change, next_change, next_change last_redo_change, "name" from archived join positions using (source)
 where scn > 0 and (first_change >= scn or (first_change <= scn and scn < next_change))
 union all
 select o.source, 'REDO', o.thread, o."sequence", o.first_change, o.next_change,
   case when a."name" is not null then o.next_change else (select max(next_change) from seg s where s.source = o.source and s.thread = o.thread) + 7 end,
   coalesce(a."name", o.source || '/b_' || cast(o.group_no as varchar))
 from online o join positions p on p.source = o.source left join archived a on a.source = o.source and a.thread = o.thread and a."sequence" = o."sequence"
 where o.status = 'CURRENT' and (scn = 0 or o.first_change >= scn or (o.first_change <= scn and scn < o.next_change)))
"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("source"),
        F.expr("p_size % 2 + 1").alias("thread"),
        F.col("p_partkey").alias("sequence"),
        (F.col("p_partkey") * 100).alias("first_change"),
        (F.col("p_partkey") * 100 + 100).alias("next_change"),
        F.concat("p_brand", F.lit("/arch_"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("name"),
        F.col("p_type").alias("p_type"),
    )


def archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).where("p_type <> 'ECONOMY'").select(
        "source", "thread", "sequence", "first_change", "next_change", "name",
        F.lit(1).alias("dest_id"), F.lit("YES").alias("archived"),
    )


def online(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("source", "thread").orderBy(F.col("sequence").desc())
    return (
        segments(spark, sf_dir)
        .withColumn("rk", F.row_number().over(w))
        .where("rk <= 3")
        .select(
            "source", "thread", "sequence", "first_change", "next_change",
            F.when(F.col("rk") == 1, "CURRENT").otherwise("ACTIVE").alias("status"),
            (F.col("thread") * 10 + F.col("rk")).alias("group_no"),
            F.lit(2).alias("members"),
        )
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    disks = F.explode(F.array(F.lit("a"), F.lit("b")))
    return online(spark, sf_dir).select("source", "group_no", disks.alias("disk")).select(
        "source", "group_no", F.concat("source", F.lit("/"), "disk", F.lit("_"), F.col("group_no").cast("string")).alias("member")
    )


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).groupBy("source", "thread").agg((F.max("next_change") + 7).alias("thread_last_change"))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .groupBy(F.concat(F.lit("Brand#"), (F.col("s_nationkey") + 1).cast("string")).alias("source"))
        .agg((F.min("s_suppkey") * 1000).alias("scn"))
    )


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Brand#"), (F.col("s_nationkey") + 1).cast("string")).alias("source"),
        (F.col("s_suppkey") * 1000 + 500).alias("current_scn"),
    )


# ---- catalogs ---------------------------------------------------------------------------------

COLUMNS_SQL = """cols as (select p_brand "owner", 'T' || cast(p_partkey as varchar) table_name, c.* , p_type from part,
 (values ('ID',1,'N','NUMBER',22,0,10,'NO'), ('NAME',2,'Y','VARCHAR2',40,null,null,'NO'), ('PRICE',3,'Y','NUMBER',22,2,12,'NO'),
  ('CREATED',4,'Y','DATE',7,null,null,'NO'), ('SYS_NC1',5,'Y','RAW',8,null,null,'YES')) c(column_name, column_id, nullable, data_type, data_length, data_scale, data_precision, hidden_column))"""


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("owner"),
        F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("table_name"),
        "p_type", "p_size", "p_partkey",
    )


def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = """explode(array(
      named_struct('column_name','ID','column_id',1,'nullable','N','data_type','NUMBER','data_length',22,'data_scale',0,'data_precision',10,'hidden_column','NO'),
      named_struct('column_name','NAME','column_id',2,'nullable','Y','data_type','VARCHAR2','data_length',40,'data_scale',cast(null as int),'data_precision',cast(null as int),'hidden_column','NO'),
      named_struct('column_name','PRICE','column_id',3,'nullable','Y','data_type','NUMBER','data_length',22,'data_scale',2,'data_precision',12,'hidden_column','NO'),
      named_struct('column_name','CREATED','column_id',4,'nullable','Y','data_type','DATE','data_length',7,'data_scale',cast(null as int),'data_precision',cast(null as int),'hidden_column','NO'),
      named_struct('column_name','SYS_NC1','column_id',5,'nullable','Y','data_type','RAW','data_length',8,'data_scale',cast(null as int),'data_precision',cast(null as int),'hidden_column','YES')))"""
    return (
        catalog_tables(spark, sf_dir)
        .select("owner", "table_name", F.expr(cells).alias("c"))
        .select("owner", "table_name", "c.*", F.lit("NO").alias("virtual_column"))
    )


def constraints(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(constraints, constraint columns): a primary key unless PROMO, and a check on NAME for all."""
    t = catalog_tables(spark, sf_dir)
    made = t.select(
        "owner", "table_name",
        F.explode(F.expr("filter(array(if(p_type <> 'PROMO', named_struct('t','P','c','ID'), null), named_struct('t','C','c','NAME')), x -> x is not null)")).alias("k"),
    ).select("owner", "table_name", F.concat_ws("_", F.col("k.t"), "table_name").alias("constraint_name"), F.col("k.t").alias("constraint_type"), F.col("k.c").alias("column_name"))
    return made.drop("column_name"), made.drop("constraint_type")


def indexes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(indexes, index columns): two unique ones over NAME for SMALL and LARGE, a plain one over PRICE."""
    t = catalog_tables(spark, sf_dir)
    spec = """explode(filter(array(
      if(p_type in ('SMALL','LARGE'), named_struct('n','U1','u','UNIQUE','c','NAME'), null),
      if(p_type in ('SMALL','LARGE'), named_struct('n','U2','u','UNIQUE','c','NAME'), null),
      named_struct('n','I1','u','NONUNIQUE','c','PRICE')), x -> x is not null))"""
    made = t.select("owner", "table_name", F.expr(spec).alias("i")).select(
        "owner", "table_name", F.col("owner").alias("index_owner"),
        F.concat_ws("_", "i.n", "table_name").alias("index_name"), F.col("i.u").alias("uniqueness"), F.col("i.c").alias("column_name"),
    )
    return made.drop("column_name"), made.drop("uniqueness")


def namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("long")
    return brands.select((number + 2200).alias("oid"), F.when(number == 3, "pg_toast").otherwise(F.col("p_brand")).alias("nspname"))


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.regexp_extract("owner", r"(\d+)", 1).cast("long")
    letter = F.expr("case p_type when 'SMALL' then 'n' when 'LARGE' then 'd' when 'MEDIUM' then 'i' when 'PROMO' then 'f' when 'ECONOMY' then 'f' else 'x' end")
    return catalog_tables(spark, sf_dir).select(
        F.col("table_name").alias("relname"), (number + 2200).alias("relnamespace"), letter.alias("relreplident")
    )


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type per part, arrays for PROMO; brand 20, 25 and 43 stand in for nothing special."""
    number = F.regexp_extract("owner", r"(\d+)", 1).cast("long")
    return catalog_tables(spark, sf_dir).select(
        (F.col("p_partkey") + 16384).alias("oid"),
        F.concat(F.lit("ty_"), F.col("table_name")).alias("typname"),
        (number + 2200).alias("typnamespace"),
        F.when(F.col("p_type") == "PROMO", "A").otherwise("S").alias("typcategory"),
    )


def type_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types of the sources' catalogs together with the server's own."""
    from cdcflow.operators.dictionary import type_oids

    own = spark.createDataFrame([(20, "bigint"), (25, "text"), (1043, "varchar")], "oid bigint, type string")
    return type_oids(types(spark, sf_dir), namespaces(spark, sf_dir)).unionByName(own)
