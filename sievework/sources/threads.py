"""Exported threads: topic files, digests of one author's utterances, and posts that name their parent.

Texts become one row per line, and lines become entries by windows and joins over (document, place). A document is one
row's text, so what a window or a list holds is never more than that row held. Null and empty texts give no entries.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.functions import labels as L
from sievework.functions import text as T
from sievework.scratch import cut
from sievework.sources.parse import tree

#: The lines of exported topics and digests.
ROOT_AUTHOR = r"\*\*楼主\*\*\s*[:：]\s*([^\s　*]+)"
ROOT_TIME = r"\*\*楼主\*\*\s*[:：]\s*[^\s　*]+\s*　?\s*\*\*时间\*\*\s*[:：]\s*(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2})"
ROOT_LINK = r"\*\*链接\*\*\s*[:：]\s*(https?://\S+)"
TARGETS = r"\*\*参与的目标用户\*\*\s*[:：]\s*(.+)"
REPLY = r"^( *)- \[(.*)\]\((https?://[^)\s]+)\) — (.+?) (\d{2}-\d{2}) (\d{2}:\d{2})(?: \((\d+) bytes\))?\s*$"
EDITED = "^本帖于.*编辑$"
POST_URL = r"/([^/]+)/(\d+)\.html"
NO_BODY = ("（无正文，标题即内容）", "（正文为空）")
DIGEST_HEAD = r"(?m)^# (\S+) 的发言整理\s*$"
DIGEST_TOPIC = r"^楼主 (\S+) · (\d{4}-\d{2}-\d{2} \d{2}:\d{2}) · \[原帖\]\((https?://[^)\s]+)\)"
DIGEST_ENTRY = r"^### (\d{4}-\d{2}-\d{2} \d{2}:\d{2}) · (.*)$"
DIGEST_ANSWER = r"^> 回复 (\S+?)「(.*?)」(?:：.*)?$"
IMAGE = r"^!?\[[^\]]*\]\([^)]*\)\s*$"
MOST_TITLE = 120


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r]", -1)


def _part(text: Column, pattern: str, group: int = 1) -> Column:
    return T.null_if_empty(F.regexp_extract(text, pattern, group))


def _with_title(title: Column, text: Column) -> Column:
    return T.ustrip(F.concat(title, F.when(text != "", F.concat(F.lit("\n"), text)).otherwise("")))


def topics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per entry of a target author in topic files: ids, kind, time, title, whole text, body status, parent and
    direct replies. A reply's year is the root's, or the next where its month is earlier. A document that is no topic or
    names no root has no entries."""
    t = F.coalesce(F.col(text), F.lit(""))
    head = docs.filter(L.sniffed(F.lit(""), F.col(text)) == "topic").select(
        F.col(key).alias("doc"), _part(t, r"(?m)^# (.*)$").alias("root_title"), _part(t, ROOT_AUTHOR).alias("root_author"), _part(t, ROOT_TIME).alias("time"),
        _part(_part(t, ROOT_LINK), POST_URL).alias("board"), _part(_part(t, ROOT_LINK), POST_URL, 2).alias("root_id"), _part(t, ROOT_LINK).alias("root_url"),
        F.transform(F.split(F.coalesce(_part(t, TARGETS), F.lit("")), ","), lambda x: F.trim(x)).alias("targets"),
        T.ustrip(F.array_join(F.filter(_lines(T.ustrip(F.regexp_extract(t, "(?s)## 主帖(.*?)## 跟帖", 1))), lambda x: ~F.trim(x).rlike(EDITED)), "\n")).alias("body"),
        F.slice(_lines(F.regexp_extract(t, "(?s)## 跟帖(.*)$", 1)), 2, 1 << 30).alias("lines"))
    head = head.filter("root_id is not null and root_author is not null")
    line = head.select("doc", "time", "board", F.posexplode("lines").alias("pos", "line"))
    line = line.withColumn("at", F.last(F.when(F.col("line").rlike(REPLY), F.col("pos")), ignorenulls=True).over(W.partitionBy("doc").orderBy("pos"))).filter("at is not null")
    words = line.filter("pos > at").withColumn("quoted", F.col("line").rlike("^ *> ?.*$")).filter("quoted").groupBy("doc", "at").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: F.regexp_replace(x["line"], "^ *> ?", "")).alias("said"))
    group = lambda i: F.regexp_extract("line", REPLY, i)
    year, root_month = F.substring("time", 1, 4).cast("int"), F.substring("time", 6, 2).cast("int")
    replies = line.filter("pos = at").join(words, ["doc", "at"], "left").select(
        "doc", F.col("pos").alias("place"), (F.floor(F.length(group(1)) / 2) + 1).cast("int").alias("depth"), F.regexp_extract(group(3), POST_URL, 2).alias("post_id"), group(3).alias("url"), "board",
        F.regexp_replace(T.ustrip(F.replace(group(4), F.lit("⭐"), F.lit(""))), r"^\*+|\*+$", "").alias("author"), T.ustrip(group(4)).endswith("⭐").alias("target"), group(2).alias("title"),
        F.concat_ws("", F.lpad((year + (group(5).substr(1, 2).cast("int") < root_month).cast("int")).cast("string"), 4, "0"), F.lit("-"), group(5), F.lit(" "), group(6), F.lit(":00")).alias("published_at"),
        F.coalesce(F.try_to_number(T.null_if_empty(group(7)), F.lit("999999999999")), F.lit(0)).cast("long").alias("body_bytes"), L.own_words(F.coalesce("said", F.array().cast("array<string>"))).alias("body"))
    replies = replies.join(head.select("doc", F.col("time").isNull().alias("undated")), "doc").withColumns({
        "published_at": F.when(~F.col("undated"), F.col("published_at")), "body": F.when(F.col("body").contains("尚未抓取") & (F.length("body") < 40), "").otherwise(F.col("body"))}).drop("undated")
    none = F.col("body").isin(*NO_BODY)
    roots = head.select(
        "doc", F.lit(-1).alias("place"), F.lit(0).alias("depth"), F.col("root_id").alias("post_id"), F.col("root_url").alias("url"), "board", F.col("root_author").alias("author"),
        F.array_contains("targets", F.col("root_author")).alias("target"), F.coalesce("root_title", F.lit("")).alias("title"), F.concat("time", F.lit(":00")).alias("published_at"), F.when(none, F.lit(0).cast("long")).alias("body_bytes"),
        F.when(none | (F.col("body").startswith("（") & F.col("body").contains("尚未抓取")), "").otherwise(F.col("body")).alias("body"))
    nodes = tree(roots.unionByName(replies), "doc", "place", "depth", "post_id").withColumn("parent", F.when(F.col("depth") > 0, F.col("parent")))
    short = F.substring("title", 1, MOST_TITLE).alias("title")
    above = nodes.select("doc", F.col("post_id").alias("parent"), F.struct("post_id", "author", short, "published_at").alias("parent_post")).dropDuplicates(["doc", "parent"])
    below = nodes.filter("parent is not null").groupBy("doc", F.col("parent").alias("post_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "post_id", "author", short, "depth", "body_bytes", "published_at"))), lambda x: x.dropFields("place")).alias("replies"))
    status = F.when((F.col("depth") == 0) & (F.col("body") != ""), "body_exported").when(F.col("body_bytes") == 0, "title_only").when(F.col("body") != "", "body_exported").otherwise("body_missing")
    found = nodes.filter("target").join(above, ["doc", "parent"], "left").join(below, ["doc", "post_id"], "left").join(head.select("doc", "root_id", "root_title"), "doc")
    said = _with_title(F.col("title"), F.col("body"))
    return found.select(
        F.col("doc").alias(key), "place", "post_id", "url", "board", "author", F.when(F.col("depth") == 0, "post").otherwise("reply").alias("kind"), "published_at", short, said.alias("text"), status.alias("body_status"), "body_bytes",
        F.col("root_id").alias("root_post_id"), F.substring("root_title", 1, MOST_TITLE).alias("root_title"), F.col("parent_post").alias("parent"), "replies", F.sha2(said, 256).alias("sha256"))


def digests(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per utterance of a digest of one author. A reply has no link of its own: its id is made of the root's,
    its minute and its author, and of its title too where two of a document would share it."""
    t = F.coalesce(F.col(text), F.lit(""))
    head = docs.filter(t.rlike(DIGEST_HEAD) & F.contains(t, F.lit("### ")) & F.contains(t, F.lit("楼主 "))).select(F.col(key).alias("doc"), F.regexp_extract(t, DIGEST_HEAD, 1).alias("author"), F.posexplode(_lines(t)).alias("pos", "line"))
    by_place = W.partitionBy("doc").orderBy("pos")
    starts = F.col("line").startswith("## ")
    line = head.withColumns({"topic": F.sum(starts.cast("int")).over(by_place), "root_title": F.last(F.when(starts, F.trim(F.substring("line", 4, 1 << 30))), ignorenulls=True).over(by_place)}).filter("topic > 0")
    inside = W.partitionBy("doc", "topic").orderBy("pos")
    url = F.regexp_extract("line", DIGEST_TOPIC, 3)
    root = F.when(F.col("line").rlike(DIGEST_TOPIC), F.struct(
        F.regexp_extract("line", DIGEST_TOPIC, 1).alias("author"), F.regexp_extract("line", DIGEST_TOPIC, 2).alias("time"), url.alias("url"), F.regexp_extract(url, POST_URL, 1).alias("board"), _part(url, POST_URL, 2).alias("post_id")))
    line = line.filter(~starts).withColumn("root", F.last(root, ignorenulls=True).over(inside)).filter(~F.col("line").rlike(DIGEST_TOPIC))
    begins = F.col("line").rlike(DIGEST_ENTRY) & F.col("root.post_id").isNotNull()
    line = line.withColumn("at", F.last(F.when(begins, F.col("pos")), ignorenulls=True).over(inside)).filter("at is not null")
    entry = line.filter("pos = at").join(line.filter("pos > at and trim(line) <> ''").groupBy("doc", "at").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]).alias("said")), ["doc", "at"], "left")
    said = F.coalesce("said", F.array().cast("array<string>"))
    # Answers that come before any other line name the parent; the rest is the body.
    own = F.filter(F.transform(said, lambda x, i: F.when(~F.trim(x).rlike(DIGEST_ANSWER), i)), lambda i: i.isNotNull())
    before = F.coalesce(F.get(own, F.lit(0)), F.size(said))
    entry = entry.withColumns({"before": before, "said": said}).withColumns({
        "answered": F.get("said", F.col("before") - 1), "body": T.ustrip(F.array_join(F.filter(F.slice("said", F.col("before") + 1, F.size("said")), lambda x: ~F.trim(x).rlike(IMAGE)), "\n")),
        "time": F.regexp_extract("line", DIGEST_ENTRY, 1), "title": F.substring(F.trim(F.regexp_extract("line", DIGEST_ENTRY, 2)), 1, MOST_TITLE)})
    is_root = (F.col("root.author") == F.col("author")) & (F.col("root.time") == F.col("time"))
    body = F.col("body")
    title_only, missing = body.startswith("（标题即全文）"), body.startswith("（") & body.contains("未抓到")
    status = F.when(title_only, "title_only").when(missing, "body_missing").when(body != "", "body_exported").otherwise("title_only")
    own_id = F.concat("root.post_id", F.lit("r"), F.regexp_replace("time", "[- :]", ""), F.substring(F.sha1("author"), 1, 4))
    entry = entry.withColumns({"is_root": is_root, "post_id": F.when(is_root, F.col("root.post_id")).otherwise(own_id), "body_status": status, "body": F.when(title_only | missing, "").otherwise(body)})
    twice = ~F.col("is_root") & (F.count("*").over(W.partitionBy("doc", "post_id")) > 1)
    named = F.trim("answered")
    parent = F.when(named.rlike(DIGEST_ANSWER), F.struct(F.lit(None).cast("string").alias("post_id"), F.regexp_extract(named, DIGEST_ANSWER, 1).alias("author"), F.substring(F.regexp_extract(named, DIGEST_ANSWER, 2), 1, MOST_TITLE).alias("title"), F.lit(None).cast("string").alias("published_at"))).when(
        ~F.col("is_root"), F.struct("root.post_id", "root.author", F.substring("root_title", 1, MOST_TITLE).alias("title"), F.concat("root.time", F.lit(":00")).alias("published_at")))
    whole = _with_title(F.col("title"), F.col("body"))
    return entry.select(
        F.col("doc").alias(key), F.col("at").alias("place"), F.concat("post_id", F.when(twice, F.concat(F.lit("t"), F.substring(F.sha1("title"), 1, 4))).otherwise("")).alias("post_id"), "root.url", "root.board", "author",
        F.when(F.col("is_root"), "post").otherwise("reply").alias("kind"), F.concat("time", F.lit(":00")).alias("published_at"), "title", whole.alias("text"), "body_status",
        F.when(F.col("body_status") == "title_only", 0).otherwise(F.octet_length("body")).cast("long").alias("body_bytes"), F.col("root.post_id").alias("root_post_id"), F.substring("root_title", 1, MOST_TITLE).alias("root_title"), parent.alias("parent"), F.sha2(whole, 256).alias("sha256"))


def walked(posts: DataFrame, topic: str, node: str, parent: str, order: str) -> DataFrame:
    """Posts of topics that can be reached from their root (a post without a parent), with ``depth`` and ``place``: the number in
    a walk that visits a post before its answers, and answers by ``order``, then id. One join a level, as many as the deepest thread has; each level's
    lineage is cut by a checkpoint, in the folder that ``spark.checkpoint.dir`` names; only a local master may do without."""
    rows = posts.select(topic, node, parent, order).dropDuplicates([topic, node])
    step = lambda: F.struct(F.col(order).alias("o"), F.col(node).alias("n"))
    level = rows.filter(F.col(parent).isNull()).select(topic, node, F.lit(0).alias("depth"), F.array(step()).alias("path"))
    out = level
    while True:
        above = level.select(topic, F.col(node).alias(parent), F.col("depth"), F.col("path"))
        level = rows.filter(F.col(parent).isNotNull()).join(above, [topic, parent]).select(topic, node, (F.col("depth") + 1).alias("depth"), F.concat("path", F.array(step())).alias("path"))
        level = cut(level)
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out.withColumn("place", F.row_number().over(W.partitionBy(topic).orderBy("path"))).drop("path")
