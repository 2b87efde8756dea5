"""The given tables reshaped into the engine's Silver and Bronze inputs.

``INPUT_SQL`` is portable: Spark and the checking database read the same text. Every given row
keeps its values; nulls and zeros are planted in added rows under ids of their own (J items, Q
snapshots, categories that end in -VOID). Silver, star and mart tables are written once per session to the shared folder, as the
batch pipeline does, and read from there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators.dedup import keep_last_by
from bazaarlens.plans import gold, marts, scoring, star
from bazaarlens.session import scratch_path
from bazaarlens.sources.bronze import envelope
from bazaarlens.sources.tables import PAYLOAD_GROUP, read_table, write_table

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

INPUT_SQL = {
    "categories": """
select
    category_id,
    category_name,
    'https://img.example.com/' || category_id as picture_url,
    case when kind = '' then cast(lines * boost as bigint) end as total_items_in_this_category,
    'Catalog > ' || p_type || case when p_brand like '%1%' then ' > ' || p_brand else '' end as path_from_root,
    children as children_categories_count,
    case when p_brand like '%2%' then 'variations' else null end as attribute_types,
    p_brand like '%3%' as settings_adult_content,
    ingested_at,
    'public_api' as source
from (
    select
        p_brand, p_type, kind,
        p_brand || '-' || p_type || kind as category_id,
        p_type || ' ' || p_brand || kind as category_name,
        sum(cast(l_quantity as bigint)) as lines,
        case when p_brand = 'Brand#13' and p_type = 'ECONOMY' then 20 when p_brand = 'Brand#13' then 12 else 1 end as boost,
        count(distinct p_size) as children,
        max(cast(l_shipdate as timestamp)) as ingested_at
    from {lineitem}
    join (select p.*, '' as kind from {part} p union all select p.*, '-VOID' from {part} p where p_brand = 'Brand#7') parts
        on l_partkey = p_partkey
    group by p_brand, p_type, kind
) grouped
""",
    "domains": """
select
    domain_id || '__' || category_id as domain_category_id,
    search_query || '__' || domain_id || '__' || category_id as query_domain_category_id,
    domain_id, domain_name, category_id, category_name, search_query, ingested_at,
    'public_api' as source
from (
    select domain_id, domain_name, category_id, category_name, search_query, max(landed) as ingested_at
    from (
        select
            'DOM-' || n_name as domain_id,
            n_name as domain_name,
            case when n_name = 'NATION_7' then 'GONE-' || p_type else p_brand || '-' || p_type end as category_id,
            case when n_name = 'NATION_7' then p_type else p_type || ' ' || p_brand end as category_name,
            nullif(p_name, 'red widget') as search_query,
            cast(l_shipdate as timestamp) as landed
        from {lineitem}
        join {part} on l_partkey = p_partkey
        join {supplier} on l_suppkey = s_suppkey
        join {nation} on s_nationkey = n_nationkey
    ) discovered
    group by domain_id, domain_name, category_id, category_name, search_query
) grouped
""",
    "item_details": """
select
    item_id, title, price, currency_id, available_quantity, sold_quantity, status, item_condition as condition,
    category_id, listing_type_id, permalink, seller_id, site_id, date_created, last_updated, ingested_at, source
from (
    select
        kind || l_partkey || '-' || l_suppkey as item_id,
        p_name as title,
        case when kind = 'J' and l_discount > 0.095 then null else l_extendedprice end as price,
        'BRL' as currency_id,
        case when kind = 'J' and l_tax > 0.075 then null when l_linestatus = 'O' then cast(p_size as bigint) else 0 end as available_quantity,
        case when l_returnflag = 'R' then 0 else cast(l_quantity as bigint) end as sold_quantity,
        case l_returnflag when 'A' then 'active' when 'N' then 'paused' end as status,
        case when p_size > 25 then 'new' else 'used' end as item_condition,
        case when kind = 'I' or p_brand <> 'Brand#25' then p_brand || '-' || p_type end as category_id,
        case when l_linestatus = 'O' then 'gold' else 'free' end as listing_type_id,
        'https://shop.example.com/' || l_partkey || '/' || l_suppkey as permalink,
        case when kind = 'I' or l_suppkey <> 13 then cast(l_suppkey as string) end as seller_id,
        'S1' as site_id,
        cast(l_shipdate as timestamp) as date_created,
        cast(l_shipdate as timestamp) as last_updated,
        cast(l_shipdate as timestamp) as ingested_at,
        'seller_api' as source,
        row_number() over (
            partition by kind, l_partkey, l_suppkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc
        ) as nth
    from (
        select l.*, 'I' as kind from {lineitem} l union all select l.*, 'J' from {lineitem} l where l_linenumber = 1
    ) lines join {part} on l_partkey = p_partkey
) ranked
where nth = 1
""",
    "item_price_snapshots": """
select
    item_id, seller_id, category_id, price, base_price, original_price, currency_id, available_quantity,
    sold_quantity, status, item_condition as condition, snapshot_date as last_updated, snapshot_date,
    cast(year(snapshot_date) * 10000 + month(snapshot_date) * 100 + day(snapshot_date) as bigint) as snapshot_date_key,
    snapshot_date as ingested_at, 'seller_api' as source
from (
    select
        kind || l_partkey as item_id,
        cast(l_suppkey as string) as seller_id,
        p_brand || '-' || p_type as category_id,
        case when kind = 'P' then l_extendedprice when l_discount < 0.005 then 0.0 when l_discount <= 0.095 then l_extendedprice end as price,
        l_extendedprice as base_price,
        case when l_returnflag = 'N' then null else p_retailprice end as original_price,
        'BRL' as currency_id,
        cast(p_size as bigint) as available_quantity,
        cast(l_quantity as bigint) as sold_quantity,
        case l_returnflag when 'A' then 'active' when 'N' then 'paused' end as status,
        case when p_size > 25 then 'new' else 'used' end as item_condition,
        cast(l_shipdate as timestamp) as snapshot_date,
        row_number() over (
            partition by kind, l_partkey, l_shipdate order by l_orderkey desc, l_linenumber desc
        ) as nth
    from (
        select l.*, 'P' as kind from {lineitem} l union all select l.*, 'Q' from {lineitem} l where l_linenumber = 1
    ) lines join {part} on l_partkey = p_partkey
) ranked
where nth = 1
""",
    "category_snapshots": """
select
    event_type as category_id,
    cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as bigint) as snapshot_date_key,
    cast(sum(cast(value as decimal(18,2))) as double) / count(*) as opportunity_score
from {events}
group by event_type, cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as bigint)
""",
}

# question texts put before the user turns, chosen by conversation: the turns themselves contain
# no keyword
QUESTIONS = [
    "Quais sao as melhores oportunidades?",
    "Existe alguma ANOMALIA nos dados?",
    "Houve variação de preço?",
    "Mostre um resumo geral",
    "O clustering esta pronto?",
    "Como esta o meu seller?",
    "Qual categoria do vendedor tem mais anuncios?",
    "Quanto estoque existe?",
    "Quanto o seller vendeu?",
    "Liste anuncios pausados",
    "Quais anuncios sem venda?",
    "Liste os produtos com mais estoque",
    "Quais produtos tem preco maior?",
    "Lista de anuncios ativos",
    "Bom dia",
]

_STORED: dict[tuple[str, str, str], str] = {}

PART = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


ROWS_PER_RANK = 1_000_000  # lines that a task is meant to sort
HOT_PART = 4 * ROWS_PER_RANK
WRITERS = 200  # up to so many partitions a task writes its rows as they come, without a buffer


def _by_part(lines: DataFrame) -> DataFrame:
    """Lines dealt by their part, so that ranks and the join with the part need no other shuffle.

    Few lines share a key, so a rank in the scan tasks would sort all lines of a split and drop hardly any; a
    split of many lines would spill. With a part of over ``HOT_PART`` lines they stay where they are, and each
    scan task sends one line a key.
    """
    most, rows = lines.groupBy("l_partkey").count().agg(F.max("count"), F.sum("count")).first()
    if (most or 0) > HOT_PART:
        return lines
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(max(parts, min(WRITERS, math.ceil((rows or 0) / ROWS_PER_RANK))), "l_partkey")


def _latest_lines(lake: Lake, kinds: tuple[str, str], keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The rows of ``ranked`` in ``INPUT_SQL`` with ``nth = 1``: all lines as the first kind and those numbered 1
    as the second, the last one per key in ``order``, with its part.

    The columns of a line are ranked and only then joined with the part, which is chosen by its key alone:
    tasks sort and send a third of the width, and texts are put together for the rows that stay.
    """
    lines = _by_part(lake.raw("lineitem").select(*dict.fromkeys([*keys, *order, *columns, "l_linenumber"])))
    first, second = map(F.lit, kinds)
    every = lines.withColumn("kind", F.explode(F.when(F.col("l_linenumber") == 1, F.array(first, second)).otherwise(F.array(first))))
    latest = keep_last_by(every, [*keys, "kind"], [F.col(c).desc_nulls_last() for c in order])
    # a repeated part key joined each line to several parts, of which the rank kept one
    parts = keep_last_by(lake.raw("part").select("p_partkey", *PART), ["p_partkey"], [F.col(c).desc_nulls_last() for c in PART])
    return latest.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def _item_details(lake: Lake) -> DataFrame:
    columns = ["l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_linestatus", "l_returnflag"]
    ranked = _latest_lines(lake, ("I", "J"), ["l_partkey", "l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], columns)
    return _over_ranked(lake, "item_details", ranked)


def _item_price_snapshots(lake: Lake) -> DataFrame:
    columns = ["l_extendedprice", "l_discount", "l_quantity", "l_returnflag", "l_suppkey"]
    ranked = _latest_lines(lake, ("P", "Q"), ["l_partkey", "l_shipdate"], ["l_orderkey", "l_linenumber"], columns)
    return _over_ranked(lake, "item_price_snapshots", ranked)


def _over_ranked(lake: Lake, name: str, ranked: DataFrame) -> DataFrame:
    """The column expressions of ``INPUT_SQL[name]`` over lines that are ranked already."""
    outer, rest = INPUT_SQL[name].split("from (", 1)
    inner = rest[: rest.index("row_number()")].rstrip().rstrip(",")
    return lake.spark.sql(f"{outer} from ({inner} from {{ranked}})", ranked=ranked)


WIDE_INPUTS = {"item_details": _item_details, "item_price_snapshots": _item_price_snapshots}


class Stored(Mapping):
    """Tables by name; one is built when it is first asked for."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]) -> None:
        self.names, self.build = list(names), build

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        return self.build(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


class Lake:
    """Frames over one directory of given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        used = {t: self.raw(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **{**used, **frames})

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The named table, written to the shared folder on first use in this session."""
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in _STORED:
            path = self.bronze_path(name.removeprefix("bronze_")) if name.startswith("bronze_") else scratch_path(self.spark, name)
            write_table(build(), path, options=PAYLOAD_GROUP if name.startswith("bronze_") else None)
            _STORED[key] = path
        return read_table(self.spark, _STORED[key])

    # --- Silver ------------------------------------------------------------------------------

    def silver(self, name: str) -> DataFrame:
        return self.stored(name, lambda: WIDE_INPUTS[name](self) if name in WIDE_INPUTS else self.sql(INPUT_SQL[name]))

    @property
    def categories(self) -> DataFrame:
        return self.silver("categories")

    @property
    def domains(self) -> DataFrame:
        return self.silver("domains")

    @property
    def items(self) -> DataFrame:
        return self.silver("item_details")

    @property
    def prices(self) -> DataFrame:
        return self.silver("item_price_snapshots")

    @property
    def category_snapshots(self) -> DataFrame:
        return self.sql(INPUT_SQL["category_snapshots"])

    def silver_tables(self) -> dict[str, DataFrame]:
        return {
            "categories": self.categories, "domain_discovery": self.domains,
            "item_details": self.items, "item_price_snapshots": self.prices,
        }

    # --- Gold, star, marts, models -----------------------------------------------------------

    @property
    def category_metrics(self) -> DataFrame:
        return self.stored("category_metrics", lambda: gold.gold_category_metrics(self.categories, self.domains))

    @property
    def overview(self) -> DataFrame:
        return self.stored("overview", lambda: gold.gold_marketplace_overview(self.categories, self.domains))

    @property
    def query_metrics(self) -> DataFrame:
        return self.stored(
            "query_metrics", lambda: gold.gold_public_query_metrics(self.categories, self.domains)
        )

    @property
    def price_history(self) -> DataFrame:
        return self.stored("price_history", lambda: gold.gold_price_history(self.prices))

    def star_plan(self, *names: str) -> dict[str, DataFrame]:
        """Plans of the named tables, of all by default; inputs are read for those only."""
        parts = {"categories": lambda: self.categories, "domains": lambda: self.domains, "items": lambda: self.items,
                 "metrics": lambda: self.category_metrics, "overview": lambda: self.overview}
        return {name: build(*(parts[p]() for p in needed)) for name, (build, needed) in star.STAR.items() if not names or name in names}

    @property
    def star(self) -> Mapping[str, DataFrame]:
        """The eight tables; each is written when it is first asked for."""
        return Stored(star.STAR, lambda name: self.stored(name, lambda: self.star_plan(name)[name]))

    def mart(self, name: str) -> DataFrame:
        return self.stored(name, lambda: marts.MARTS[name](self.star))

    def all_marts(self) -> dict[str, DataFrame]:
        return {name: self.mart(name) for name in marts.MARTS}

    @property
    def features(self) -> DataFrame:
        return self.stored("features", lambda: scoring.build_category_features(self.mart("mart_category_metrics")))

    @property
    def anomalies(self) -> DataFrame:
        return self.stored("anomalies", lambda: scoring.detect_anomalies(self.features))

    @property
    def scores(self) -> DataFrame:
        return self.stored("scores", lambda: scoring.calculate_opportunity_score(self.anomalies))

    # --- Bronze ------------------------------------------------------------------------------

    @property
    def bronze_root(self) -> str:
        """The folder of this session's Bronze tables, laid out as the pipeline reads them."""
        return _STORED.setdefault((self.spark.sparkContext.applicationId, self.dir, "bronze"), scratch_path(self.spark, "bronze"))

    def bronze_path(self, entity: str) -> str:
        return f"{self.bronze_root}/parquet/{entity}"

    def bronze(self, entity: str) -> DataFrame:
        return self.stored(f"bronze_{entity}", getattr(self, f"_bronze_{entity}"))

    def _landed_lines(self) -> DataFrame:
        """Every line with its part; the landing time is unique per item."""
        lines = self.raw("lineitem").join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
        micros = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
        offset = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        return lines.withColumn("landed", F.timestamp_micros(micros + offset))

    def _bronze_item_details(self) -> DataFrame:
        lines = self._landed_lines()
        flag, day = F.col("l_returnflag"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        payload = F.struct(
            F.concat(F.lit("I"), "l_partkey", F.lit("-"), "l_suppkey").alias("id"),
            F.col("p_name").alias("title"),
            F.when(F.col("l_discount") <= 0.095, F.col("l_extendedprice")).alias("price"),
            F.lit("BRL").alias("currency_id"),
            F.when(F.col("p_size") == 13, "n/a").otherwise(F.col("p_size").cast("string")).alias("available_quantity"),
            F.col("l_quantity").alias("sold_quantity"),
            F.when(flag == "A", "active").when(flag == "N", "paused").alias("status"),
            F.when(F.col("p_size") > 25, "new").otherwise("used").alias("condition"),
            F.concat("p_brand", F.lit("-"), "p_type").alias("category_id"),
            F.concat(F.lit("https://shop.example.com/"), "l_partkey").alias("permalink"),
            F.col("l_suppkey").alias("seller_id"),
            day.alias("date_created"),
            F.when(F.col("l_linestatus") == "F", "not a date").otherwise(day).alias("last_updated"),
            F.struct(F.lit("ignored").alias("nested")).alias("shipping"),
        )
        rows = lines.select(F.to_json(payload).alias("payload"), "landed")
        return envelope(rows, "payload", "seller_api", "/items?ids=batch", F.col("landed"))

    def _bronze_item_price_snapshots(self) -> DataFrame:
        """Each line landed twice, word for word."""
        lines = self._landed_lines()
        payload = F.struct(
            F.concat(F.lit("P"), "l_partkey").alias("id"),
            F.when(F.col("l_linestatus") == "O", F.concat(F.lit("P"), "l_partkey")).alias("item_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.concat("p_brand", F.lit("-"), "p_type").alias("category_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("p_retailprice").cast("string").alias("base_price"),
            F.lit("BRL").alias("currency_id"),
            F.col("p_size").alias("available_quantity"),
            F.col("l_quantity").cast("bigint").alias("sold_quantity"),
            F.when(F.col("l_returnflag") == "A", "active").alias("status"),
        )
        rows = lines.select(F.to_json(payload).alias("payload"), "landed")
        once = envelope(rows, "payload", "seller_api", "/items?ids=batch", F.col("landed"))
        return once.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")

    def _bronze_categories(self) -> DataFrame:
        """One record per category and shipping year."""
        yearly = self.sql(
            """
            select p_brand, p_type, year(l_shipdate) as y, sum(cast(l_quantity as bigint)) as items,
                count(distinct p_size) as children, max(cast(l_shipdate as timestamp)) as landed
            from {lineitem} join {part} on l_partkey = p_partkey group by 1, 2, 3
            """
        )
        brand, kind = F.col("p_brand"), F.col("p_type")

        def node(name):
            return F.struct(name.alias("name"))

        path = (
            F.when(brand == "Brand#9", F.lit(None))
            .when(brand == "Brand#5", F.array(node(F.lit("Catalog")), node(F.lit(None).cast("string")), node(kind)))
            .otherwise(F.array(node(F.lit("Catalog")), node(kind), node(brand)))
        )
        children = F.transform(F.sequence(F.lit(1), F.col("children").cast("int")), lambda i: F.struct(i.alias("id")))
        payload = F.struct(
            F.concat(brand, F.lit("-"), kind).alias("id"),
            F.concat(kind, F.lit(" "), brand).alias("name"),
            F.concat(F.lit("https://img.example.com/"), brand).alias("picture"),
            F.when(brand == "Brand#7", "many").otherwise(F.col("items").cast("string")).alias("total_items_in_this_category"),
            path.alias("path_from_root"),
            F.when(brand != "Brand#4", children).alias("children_categories"),
            F.when(kind == "PROMO", "variations").alias("attribute_types"),
            F.struct((kind == "SMALL").alias("adult_content")).alias("settings"),
        )
        rows = yearly.select(F.to_json(payload).alias("payload"), "landed")
        return envelope(rows, "payload", "public_api", "/categories", F.col("landed"))

    def _bronze_domain_discovery(self) -> DataFrame:
        found = self.sql(
            """
            select n_name, p_brand, p_type, p_name, l_returnflag, max(cast(l_shipdate as timestamp)) as landed
            from {lineitem} join {part} on l_partkey = p_partkey join {supplier} on l_suppkey = s_suppkey
            join {nation} on s_nationkey = n_nationkey group by 1, 2, 3, 4, 5
            """
        )
        name = F.col("p_name")
        written = (
            F.when(F.col("p_type") == "PROMO", F.replace(name, F.lit(" "), F.lit("+")))
            .when(F.col("p_type") == "SMALL", F.replace(name, F.lit(" "), F.lit("%20")))
            .otherwise(name)
        )
        payload = F.struct(
            F.concat(F.lit("DOM-"), "n_name").alias("domain_id"),
            F.col("n_name").alias("domain_name"),
            F.concat("p_brand", F.lit("-"), "p_type").alias("category_id"),
            F.concat("p_type", F.lit(" "), "p_brand").alias("category_name"),
        )
        endpoint = F.concat(F.lit("/sites/S1/domain_discovery/search?limit=8&q="), written)
        rows = found.select(F.to_json(payload).alias("payload"), endpoint.alias("endpoint"), "landed")
        return envelope(rows, "payload", "public_api", F.col("endpoint"), F.col("landed"))

    def _bronze_item_descriptions(self) -> DataFrame:
        """Every document as a description, after an older empty revision; and items without a text."""
        docs = self.raw("documents")
        item = F.concat(F.lit("D"), F.col("doc_id"))
        newer = F.struct(item.alias("id"), F.col("text").alias("plain_text"))
        older = F.struct(item.alias("id"), F.lit("").alias("plain_text"))
        both = F.array(
            F.struct(F.lit("2024-01-02T00:00:00Z").alias("landed"), F.to_json(newer).alias("payload")),
            F.struct(F.lit("2024-01-01T00:00:00Z").alias("landed"), F.to_json(older).alias("payload")),
        )
        # items of their own without a text
        blank = F.struct(F.concat(F.lit("N"), F.col("doc_id")).alias("id"), F.lit(None).cast("string").alias("plain_text"))
        added = docs.filter("lang = 'de'").select(F.lit("2024-01-02T00:00:00Z").alias("landed"), F.to_json(blank).alias("payload"))
        rows = docs.select(F.inline(both)).unionByName(added)
        return envelope(rows, "payload", "seller_api", "/items/description", F.col("landed"))

    # --- questions and manifests -------------------------------------------------------------

    @property
    def questions(self) -> DataFrame:
        turns = self.raw("conversations").filter("role = 'user'")
        asked = F.array(*map(F.lit, QUESTIONS))
        pick = F.get(asked, (F.col("conv_id") % len(QUESTIONS)).cast("int"))
        return turns.select("conv_id", "turn", F.concat(pick, F.lit(" "), "text").alias("question"))

    @property
    def manifests(self) -> DataFrame:
        return self.stored("manifests", self._manifests)

    def _manifests(self) -> DataFrame:
        """One run per order; its lines become task outputs of both manifest shapes."""
        per_task = self.sql(
            """
            select l_orderkey, l_returnflag, sum(case when l_linestatus = 'O' then cast(l_quantity as bigint) else 0 end) as o_rows,
                sum(case when l_linestatus = 'F' then cast(l_quantity as bigint) else 0 end) as f_rows
            from {lineitem} group by 1, 2
            """
        )
        outputs = F.array(
            F.struct(F.lit("categories").alias("entity"), F.col("o_rows").alias("rows")),
            F.struct(F.lit("item_details").alias("entity"), F.col("f_rows").alias("rows")),
        )
        flag = F.col("l_returnflag")
        listed = F.to_json(outputs)
        with_status = F.to_json(F.struct(F.lit("skipped").alias("status"), outputs.alias("outputs")))
        without_status = F.to_json(F.struct(outputs.alias("outputs")))
        entry = F.concat(
            F.lit('"task_'), flag, F.lit('": '),
            F.when(flag == "A", listed).when(flag == "N", with_status).otherwise(without_status),
        )
        tasks = per_task.groupBy("l_orderkey").agg(
            *(F.max(F.when(flag == f, entry)).alias(f) for f in ("A", "N", "R"))
        )
        text = F.concat(F.lit("{"), F.concat_ws(", ", "A", "N", "R"), F.lit("}"))
        status = F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success")
        return self.raw("orders").join(tasks, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
            F.concat(F.lit("run-"), "o_orderkey").alias("run_id"),
            status.alias("status"),
            F.col("o_orderpriority").alias("query"),
            F.col("o_orderdate").cast("timestamp").alias("started_at"),
            F.timestamp_micros(
                F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey") * 1000
            ).alias("finished_at"),
            (F.col("o_custkey") / F.lit(1000.0)).alias("duration_seconds"),
            F.lit(None).cast("string").alias("error"),
            F.when(F.col("l_orderkey").isNotNull(), text).otherwise("{}").alias("tasks"),
        )
