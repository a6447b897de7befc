"""Input views of the jobs, derived from the test tables. SQL forms of the same views are in `oracles.py`."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelake.functions.links import host
from wirelake.functions.words import words
from wirelake.operators.keyed import numbered
from wirelake.plans.text import Rules
from wirelake.session import scratch_path
from wirelake.sources.store import NewsStore

LEXICON = [("the", 1.9), ("of", -1.5), ("and", 0.8), ("that", -2.1), ("der", -0.9), ("une", 1.2)]
NEGATORS = ["in", "en", "no", "nicht"]
RULES = Rules(boosters={"the": 0.293, "of": -0.293, "is": 0.4}, negators=tuple(NEGATORS), contrast="or")
# One store takes the articles of all days at once, so a day has few rows of it.
BY_MONTH = {"collected_articles": "month"}
# References with and without semicolon, numbered ones, ones that must not be read twice, and what is none.
REFERENCES = "caf&eacute; &euro;5 &#38;lt; &amp;amp; &copy2024 &notit; &notin; &#x41;&#66 &#150; &bogus; AT&T &; &Aacute&nbsp;x &hellip;"

# What the pages of `pages_stated` say before and after their date.
STATED = [
    ('<script type="application/ld+json">{"headline": "Said &amp; done", "datePublished": "', '", "keywords": ["a", "b c"]}</script>'),
    ("<script type='application/ld+json' id=x>[1, {\"name\": \"site\"}, {\"datePublished\": \"", '", "keywords": "d, e", "description": " One. "}]</script>'),
    ('<script async type=application/ld+json>{"@graph": [{"x": {"headline": "no"}}, {"headline": 7, "datePublished": "', '"}]}</script>'),
    ('<meta itemprop="datePublished" content="', '"><h3 itemprop=\'headline\'>Item &eacute; <b>head</b></h3><p itemprop=keywords>f, g</p>'),
    ('<script type="application/ld+json">{broken "datePublished": "', '"</script>'),
]


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def stream_path(self, name: str) -> str:
        """The same path as a pattern: a stream takes a table that is a single file only in this form."""
        return f"{self.folder}/{name}.parque[t]"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def latest(self, df: DataFrame, column: str) -> Column:
        """The greatest value of a column, as a scalar subquery; stands for the present."""
        return df.select(F.max(column)).scalar()

    # --- company list ---

    def reference_data(self) -> DataFrame:
        key = F.col("s_suppkey")
        site = F.concat(F.lit(" https://www.corp"), (key % 40).cast("string"), F.lit(".example.com/newsroom "))
        return self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            key.alias("id"), F.col("s_name").alias("corporation"), F.col("n_name").alias("sector"),
            (key % 3 != 0).alias("f100"),
            F.when(key % 11 == 0, None).when(key % 13 == 0, "   ").otherwise(site).alias("newsroom_url"),
        )

    def reference_snapshots(self) -> DataFrame:
        loaded = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, snap_id * 20)")
        copies = self.table("supplier").select("s_suppkey", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("snap_id"))
        return copies.where("s_suppkey % 3 <= snap_id").withColumn("loaded_at", loaded)

    # --- news tables ---

    def collected_articles(self) -> DataFrame:
        k = "doc_id - CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END"
        # One document every 40 minutes; wraps after 3,800 years.
        ts = "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST((doc_id * 40) % 2000000000 AS INT))"
        docs = self.table("documents").withColumn("k", F.expr(k)).withColumn("ts", F.expr(ts))
        corp = "concat('https://www.corp', CAST(k % 40 AS STRING), '.example.com/"
        return docs.select(
            F.expr(f"{corp}news/', CAST(k AS STRING))").alias("url"),
            "doc_id",
            F.col("text").alias("title"),
            F.col("text").alias("description"),
            F.expr("doc_id % 10 + 1").alias("rank"),
            F.expr(f"concat('site:', {corp}newsroom before:2024-01-31 after:2024-01-01'))").alias("query"),
            F.expr("CASE WHEN n_chars >= 100 THEN text END").alias("article_text"),
            F.expr("CASE WHEN doc_id % 4 <> 0 THEN ts - INTERVAL '1' DAY END").alias("publish_date"),
            F.expr("CASE WHEN n_chars < 100 THEN NULL WHEN doc_id % 20 < 15 THEN 'semantic' "
                   "WHEN doc_id % 20 < 19 THEN 'density' ELSE 'readability' END").alias("scraper_used"),
            F.col("ts").alias("collection_timestamp"),
            F.expr("concat('run', CAST(doc_id % 25 AS STRING))").alias("run_id"),
        )

    def as_enrichments(self, events: DataFrame) -> DataFrame:
        return events.selectExpr(
            "event_id",
            "concat('https://www.corp', CAST((user_id * 3) % 40 AS STRING), '.example.com/news/', CAST(user_id * 3 AS STRING)) AS url",
            "CASE WHEN value > 20 THEN 'positive' WHEN value < 5 THEN 'negative' ELSE 'neutral' END AS sentiment",
            "value / 100 AS sentiment_score",
            "array(event_type, CASE WHEN value > 20 THEN 'big' ELSE 'small' END) AS issue_labels",
            "array(concat('user', CAST(user_id % 7 AS STRING))) AS entity_labels",
            "props AS custom_metadata", "ts AS enrichment_timestamp",
            "CASE WHEN event_type = 'purchase' THEN 'v2.0' ELSE 'v1.0' END AS enrichment_version",
        )

    def article_enrichments(self) -> DataFrame:
        return self.as_enrichments(self.table("events"))

    # --- runs ---

    def run_queries(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "CAST(l_orderkey AS STRING) AS run_id",
            "concat('https://www.google.com/search?q=site:https://www.corp', CAST(l_suppkey % 40 AS STRING), "
            "'.example.com/newsroom+before:', date_format(l_shipdate, 'yyyy-MM-dd'), "
            "'+after:1995-01-01&gl=US&hl=en&brd_json=1') AS query",
        )

    def run_dates(self) -> DataFrame:
        """Dates and state of each run; the executed queries are rows of `run_queries`."""
        return self.table("orders").selectExpr(
            "CAST(o_orderkey AS STRING) AS run_id", "CAST(o_orderdate AS DATE) AS start_date",
            "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 10 AS INT)) AS end_date",
            "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'started' ELSE 'failed' END AS status",
            "o_orderdate AS start_timestamp",
            "o_orderdate + make_dt_interval(0, 0, 0, CAST(o_orderkey % 3600 AS INT)) AS end_timestamp",
        )

    def collection_runs(self) -> DataFrame:
        """The runs that executed a query, with their counts."""
        counts = self.table("lineitem").groupBy(F.col("l_orderkey").cast("string").alias("run_id")).agg(
            F.count("*").alias("queries_count"),
            F.sum("l_quantity").cast("long").alias("urls_collected"),
            F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(0)).cast("long").alias("articles_scraped"),
        )
        return self.run_dates().join(counts, "run_id")

    def run_events(self) -> DataFrame:
        """Starts and ends; every fifth failed run was repeated and completed."""
        orders = self.table("orders")
        run_id = "CAST(o_orderkey AS STRING) AS run_id"
        end = "o_orderdate + make_dt_interval({days}, 0, 0, CAST(o_orderkey % 3600 AS INT)) AS event_timestamp"
        started = orders.selectExpr(run_id, "0 AS seq", "'started' AS status", "CAST(0 AS BIGINT) AS urls_collected", "o_orderdate AS event_timestamp")
        ended = orders.where("o_orderstatus <> 'O'").selectExpr(
            run_id, "1", "CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'failed' END", "CAST(floor(o_totalprice) AS BIGINT)", end.format(days=0),
        )
        again = orders.where("o_orderstatus = 'P' AND o_orderkey % 5 = 0")
        return started.union(ended).union(again.selectExpr(run_id, "0", "'started'", "0L", end.format(days=1))).union(
            again.selectExpr(run_id, "1", "'completed'", "7L", end.format(days=2)))

    # --- search results and pages ---

    def serp_links(self) -> DataFrame:
        """Search rows: one per page, with a link that tries one of the link rules."""
        b = F.regexp_replace("url", "[?#].*$", "")
        tails = ["?page=2", "/newsroom/", "/category/x", "?q=merger", "?s=merger", "?s=2429&item=12", "?s=2429", "/2024/", "/2024/01/a", "?utm_source=feed"]
        link = F.col("url")
        for n, tail in enumerate(tails):
            link = F.when(F.col("page_id") % 12 == n, F.concat(b, F.lit(tail))).otherwise(link)
        title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
        return self.table("pages").select(
            "page_id", host(F.col("url")).alias("host"), title.alias("title"), link.alias("link"),
            F.when(F.col("page_id") % 5 != 0, title).alias("description"),
        )

    def serp_results(self) -> DataFrame:
        """The search rows with their rank within the host."""
        ranked = numbered(self.serp_links(), "host", "page_id", "rank")
        return ranked.withColumn("query", F.concat(F.lit("site:"), F.col("host"))).withColumn(
            "page_no", F.floor((F.col("rank") - 1) / 10).cast("int")
        )

    def serp_payloads(self) -> DataFrame:
        """The same rows as stored JSON, ten to a page; some hosts spell the rank in another type."""
        rows = self.serp_results()
        fields = F.struct("rank", "title", "description", "link")
        pages = rows.groupBy("host", "page_no").agg(
            F.array_sort(F.collect_list(fields)).alias("organic"), F.count("*").alias("n")
        )
        next_link = F.when(F.col("n") == 10, F.concat(F.lit("https://search.example.com/?start="), ((F.col("page_no") + 1) * 10).cast("string")))
        payload = F.to_json(F.struct(
            F.struct(F.concat(F.lit("site:"), F.col("host")).alias("query")).alias("general"),
            "organic", F.struct(next_link.alias("next_page_link")).alias("pagination"),
        ))
        # Ranks of some hosts are texts or fractions, and one of them none at all.
        odd = F.regexp_replace(payload, r'"rank":(\d+)', F.when(F.length("host") % 4 == 0, '"rank":"$1"').otherwise('"rank":$1.0'))
        odd = F.regexp_replace(odd, r'"rank":"?7(\.0)?"?,', '"rank":"seventh",')
        return pages.select("host", "page_no", F.when(F.length("host") % 2 == 0, odd).otherwise(payload).alias("payload"))

    def serp_attempts(self) -> DataFrame:
        """Fetch log: three attempts per page, some failing first or answered by a text that is cut off or by an empty
        list, and hosts that never succeed."""
        pages = self.serp_payloads()
        tries = pages.withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        turn = F.col("page_no") + F.length("host") + F.col("attempt")
        status = F.when(F.length("host") % 9 == 0, 500).when(turn % 4 == 0, 429).when(turn % 7 == 0, 504).otherwise(200)
        body = F.when(turn % 3 == 0, F.substring("payload", 1, 60)).when(F.length("host") % 13 == 0, '{"organic": []}').otherwise(F.col("payload"))
        return tries.select("host", "page_no", "attempt", status.alias("status"), F.when(status == 200, body).alias("payload"))

    def pages(self) -> DataFrame:
        return self.table("pages")

    def pages_mixed(self) -> DataFrame:
        """Pages of which a third lack the article tag, others the article, and some state metadata."""
        html = F.col("html")
        untagged = F.replace(F.replace(html, F.lit("<article>"), F.lit("<div>")), F.lit("</article>"), F.lit("</div>"))
        bare = F.regexp_replace(html, "(?s)<article>.*?</article>", "")
        date = F.when(F.col("page_id") % 2 == 0, "2024-02-03T04:05:06").otherwise("Feb 3, 2024")
        about = F.repeat(F.lit("This page&#8217;s own &#x201C;news&rdquo;. "), 8)
        plain_order = F.concat(
            F.lit('<meta name="description" content="'), about, F.lit('"><meta name="keywords" content="news, page">'
                  '<meta property="article:published_time" content="'), date, F.lit('">'))
        other_order = F.concat(
            F.lit("<meta content='"), about, F.lit("' name='description'/><META CONTENT='news, page' NAME=keywords>"
                  "<meta content='"), date, F.lit("' property='article:published_time'>"))
        described = F.concat(F.lit('<meta charset="utf-8">'), F.when(F.col("page_id") % 10 == 0, plain_order).otherwise(other_order))
        changed = F.when(F.col("page_id") % 3 == 0, untagged).when(F.col("page_id") % 7 == 0, bare).otherwise(html)
        meta = F.replace(changed, F.lit('<meta charset="utf-8">'), described)
        return self.table("pages").select("page_id", "url", F.when(F.col("page_id") % 5 == 0, meta).otherwise(changed).alias("html"))

    def pages_nested(self) -> DataFrame:
        """Pages with articles inside articles, some never closed, with boilerplate inside boilerplate, and with all kinds of references."""
        html = F.replace(F.col("html"), F.lit("</title>"), F.lit(f" {REFERENCES}</title>"))
        inner = F.lit(f"<article><h2>{REFERENCES}</h2><article class=quote>Inner <article>innermost</article> text</article>")
        open_end = F.lit("<ARTICLE id=a>Begin <article>never closed<p>")
        frame = F.lit(f"<aside>Ad <aside>inner ad</aside> rest of the ad<nav>x</nav></aside></form><div>{REFERENCES}")
        turned = F.replace(F.replace(html, F.lit("<article>"), frame), F.lit("</article>"), F.lit("</div><form><p>Never closed"))
        changed = F.when(F.col("page_id") % 4 == 0, F.replace(html, F.lit("<article>"), inner)).when(
            F.col("page_id") % 4 == 1, F.replace(html, F.lit("<article>"), open_end)).when(F.col("page_id") % 4 == 2, turned).otherwise(html)
        return self.table("pages").select("page_id", "url", changed.alias("html"))

    def pages_stated(self) -> DataFrame:
        """Pages that state their metadata as a JSON-LD object, list or graph, as microdata, or as JSON that is broken."""
        day = F.concat(F.lit("2024-03-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"))
        stated = F.lit("")
        for k, (head, tail) in enumerate(STATED):
            stated = F.when(F.col("page_id") % 6 == k, F.concat(F.lit(head), day, F.lit(tail))).otherwise(stated)
        untitled = F.regexp_replace("html", "<title>[^<]*</title>", "")
        html = F.when(F.col("page_id") % 4 == 0, F.col("html")).otherwise(untitled)
        return self.table("pages").select("page_id", "url", F.replace(html, F.lit("</head>"), F.concat(stated, F.lit("</head>"))).alias("html"))

    def told_texts(self) -> DataFrame:
        """Documents of which some shout and some end with marks."""
        upper = F.translate(F.substring("text", 1, 60), ascii_lowercase, ascii_uppercase)
        shouted = F.concat(upper, F.expr("substring(text, 61)"), F.lit(" !! now!"))
        return self.table("documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, shouted).when(
            F.col("doc_id") % 4 == 1, F.concat("text", F.repeat(F.lit("?"), (F.col("doc_id") % 7).cast("int")))).otherwise(F.col("text")).alias("text"))

    def word_values(self) -> DataFrame:
        """A lexicon of a fifth of all words of the documents, with values from -4 to 4 by their letters."""
        word = self.table("documents").select(F.explode(words(F.col("text"))).alias("word")).distinct()
        code = "(ascii(word) * 31 + ascii(substring(word, 2, 1)) * 17 + length(word) * 7)"
        return word.where("length(word) > 1 AND (length(word) * 7 + ascii(word)) % 5 = 0").selectExpr("word", f"CAST({code} % 81 - 40 AS DOUBLE) / 10 AS val")

    def scrape_log(self) -> DataFrame:
        return self.table("pages").selectExpr(
            "page_id", "url",
            "CASE WHEN page_id % 13 = 0 THEN NULL WHEN page_id % 4 = 0 THEN 'density' "
            "WHEN page_id % 29 = 1 THEN 'readability' ELSE 'semantic' END AS scraper_used",
            "CASE WHEN page_id % 26 = 0 THEN 'Timeout' WHEN page_id % 13 = 0 THEN 'All Scrapers Failed' END AS error_type",
            "CAST(length(html) AS DOUBLE) / 1000 AS processing_time_s",
        )

    def processed_urls(self) -> DataFrame:
        return self.serp_links().where("page_id % 3 = 0").select("link")

    def lexicon(self) -> DataFrame:
        values = ", ".join(f"('{word}', {val}D)" for word, val in LEXICON)
        return self.spark.sql(f"SELECT * FROM VALUES {values} AS l(word, val)")


class StoredViews(Views):
    """The same views, with the articles written to a store and read from there."""

    def collected_articles(self) -> DataFrame:
        news = NewsStore(self.spark, scratch_path(self.spark, "store"), BY_MONTH)
        news.append_articles(super().collected_articles(), F.col("run_id"), F.col("collection_timestamp"))
        return news.read("collected_articles")
