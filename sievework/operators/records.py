"""Whole feed records of posts and videos: what the source says, what the rules find in it, and its conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from sievework.functions import claims as C
from sievework.functions import extract as X
from sievework.functions import labels as B
from sievework.functions import learning as L
from sievework.functions import rules as R
from sievework.functions import text as T

#: Fixed values of records: lengths, states, and the fields of a reply that are kept.
EXCERPT, TITLE, REPLIES, CLAIMS = 360, 120, 80, 20
UNVALIDATED, UNVERIFIED, PENDING = "experimental_unvalidated", "author_claim_unverified", "pending_owner_spot_check"
OWNER, MODEL = "owner_supplied_summary", "gemini_video_understanding"
REPLY = ("post_id", "author", "title", "depth", "in_reply_to", "body_bytes", "published_at")
#: Authors with positions of their own, and the symbols that they hold.
TRACKED = {"麻你": ("VGT", "SGOV")}


def _given(df: DataFrame, name: str, kind: str) -> Column:
    """A column, or null where a table has none."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)


def thread_context(df: DataFrame, thread: str) -> Column:
    """The conversation of a post: its root, the post it answers, and the first replies with how many there are; reply
    bodies are counted, not kept. ``thread`` is a struct with root_post_id, is_reply, parent and replies."""
    t, kind = F.col(f"`{thread}`"), df.schema[thread].dataType
    reply = kind["replies"].dataType.elementType
    p, replies = t["parent"], F.coalesce(t["replies"], F.array().cast(ArrayType(reply)))
    known = {f.name for f in reply.fields}
    kept = F.transform(replies, lambda r: F.struct(*((r[k] if k in known else F.lit(None).cast("string")).alias(k) for k in REPLY)))
    parent = F.when(p.isNotNull(), F.struct(p["post_id"].alias("post_id"), p["author"].alias("author"), F.substring(F.coalesce(p["title"], F.lit("")), 1, TITLE).alias("title"), p["published_at"].alias("published_at")))
    return F.when(t.isNotNull(), F.struct(
        t["root_post_id"].alias("root_post_id"), F.coalesce(t["is_reply"], F.lit(False)).alias("is_reply"), parent.alias("in_reply_to"), F.size(replies).alias("reply_count"), F.slice(kept, 1, REPLIES).alias("replies"),
        F.size(F.filter(replies, lambda r: F.coalesce(r["body_bytes"], F.lit(0)) > 0)).alias("replies_with_body")))


def _symbols(text: Column) -> Column:
    return X.detect(text, R.ALIASES, list(R.TICKERS), R.CAPITALS_ONLY)


def posts(df: DataFrame, source: str, source_kind: str, captured_at: str, notice: str, tracked: dict[str, tuple[str, ...]] = TRACKED) -> DataFrame:
    """Records of posts. ``df`` has author, title, text and url, and may have date or published_at, images (an array),
    forum_entry_kind, source_entry_key, parent_post_id, attribution_fallback and thread. Missing titles, texts, dates and
    addresses are empty."""
    blank = F.lit("")
    title, text = (T.ustrip(F.coalesce(F.col(c), blank)) for c in ("title", "text"))
    published = F.coalesce(T.null_if_empty(_given(df, "date", "string").cast("string")), _given(df, "published_at", "string").cast("string"), blank)
    rows = df.withColumns({"_title": title, "_text": text, "_url": T.without_fragment(F.coalesce("url", blank)), "_published": published}).withColumn("_joined", F.concat_ws("\n", "_title", "_text"))
    joined = F.col("_joined")
    none = C.actions(F.lit(None).cast("string"), ["X"])
    own = none
    for author, symbols in tracked.items():
        own = F.when(F.col("author") == author, C.actions(F.concat_ws("\n", "_title", "_text"), list(symbols))).otherwise(own)
    thread = thread_context(df, "thread") if "thread" in df.columns and isinstance(df.schema["thread"].dataType, StructType) else F.lit(None).cast("string")
    images = F.coalesce(F.size(F.coalesce(F.col("images"), F.array().cast(df.schema["images"].dataType))), F.lit(0)) if "images" in df.columns else F.lit(0)
    extra = [_given(df, c, "string").alias(c) for c in ("forum_entry_kind", "source_entry_key", "parent_post_id", "attribution_fallback")]
    return rows.select(
        T.content_key(F.col("author"), F.col("_url"), F.col("_published"), F.col("_title")).alias("id"), F.lit(source).alias("source"), F.lit(source_kind).alias("source_kind"), "author", F.col("_published").alias("published_at"),
        F.col("_title").alias("title"), F.col("_url").alias("url"), F.substring("_text", 1, EXCERPT).alias("excerpt"), F.length("_text").cast("long").alias("content_chars"), images.cast("long").alias("images_count"), L.themes(joined).alias("themes_hint"),
        _symbols(joined).alias("symbols"), L.operations(joined).alias("operations"), L.portfolio_rules(joined).alias("portfolio_rules"), L.lessons(joined).alias("lessons"), L.signals(joined).alias("method_signals"),
        C.without_text(C.claims(joined, limit=CLAIMS)).alias("claims"), F.lit(UNVALIDATED).alias("claims_status"), own.alias("author_actions"), *extra, thread.alias("thread_context"), F.lit(captured_at).alias("captured_at"), F.lit(notice).alias("source_notice"))


def videos(df: DataFrame, captured_at: str, notice: str, owner_notice: str, model_notice: str) -> DataFrame:
    """Records of videos: ``df`` has author, role, video_id, title, url, published_at and ``acquisition``, a struct of text,
    status, quality, provider, provider_url, content_origin, timestamp_evidence, rule_candidate_allowed and structured
    (symbols, claims with symbol, macro, model, observed_title, submission_ids, summary_sha256). Operations, rules and
    lessons come only from a transcript without advertising that is allowed as a candidate for rules; a person's summary
    and a model's reading bring their claims with them, never as evidence."""
    blank, a = F.lit(""), F.col("acquisition")
    st = a["structured"]
    text, title = T.ustrip(F.coalesce(a["text"], blank)), T.ustrip(F.coalesce("title", blank))
    kept = L.without_promotion(F.col("_text"))
    rows = df.withColumns({"_text": text, "_title": title}).withColumn("_kept", F.array_join(kept["kept"], "\n")).withColumns({"_joined": T.ustrip(F.concat_ws("\n", "_title", "_kept")), "_filter": F.struct(kept["units"].alias("units"), kept["removed"].alias("removed"), kept["ratio"].alias("ratio"))})
    joined, allowed = F.col("_joined"), F.coalesce(a["rule_candidate_allowed"], F.lit(False))
    learn = (F.col("_kept") != "") & allowed
    empty = F.lit(None).cast("string")
    when = lambda found, made: F.when(learn, found).otherwise(made)
    by_owner, by_model = ((F.coalesce(a["content_origin"], blank) == o) & st.isNotNull() for o in (OWNER, MODEL))
    either = by_owner | by_model
    shaped = F.filter(F.coalesce(st["symbols"], F.array().cast("array<string>")), lambda s: s.rlike(r"^[A-Z][A-Z0-9.]{0,9}$"))
    claimed = F.filter(F.transform(F.coalesce(st["claims"], F.from_json(F.lit("[]"), ArrayType(df.schema["acquisition"].dataType["structured"].dataType["claims"].dataType.elementType))), lambda c: c["symbol"]), lambda s: F.coalesce(s, blank) != "")
    own = _symbols(joined)
    symbols = F.when(by_owner, F.array_sort(F.array_distinct(F.concat(own, claimed)))).when(by_model, F.array_sort(F.array_distinct(F.concat(own, shaped)))).otherwise(own)
    only = lambda cond, c: F.when(cond, c)
    return rows.select(
        F.substring(F.sha1(F.concat_ws("|", F.lit("youtube"), F.coalesce("author", blank), F.coalesce("video_id", blank))), 1, 20).alias("id"), F.lit("youtube").alias("source"), F.lit("video").alias("source_kind"), "author", F.coalesce("published_at", blank).alias("published_at"),
        F.col("_title").alias("title"), F.coalesce(T.null_if_empty(F.col("url")), F.concat(F.lit("https://www.youtube.com/watch?v="), F.coalesce("video_id", blank))).alias("url"), F.substring("_text", 1, EXCERPT).alias("excerpt"), F.length("_text").cast("long").alias("content_chars"),
        F.length("_kept").cast("long").alias("semantic_content_chars"), F.col("_filter").alias("content_filtering"), F.lit(0).cast("long").alias("images_count"), L.themes(joined).alias("themes_hint"), symbols.alias("symbols"),
        when(L.operations(joined), L.operations(empty)).alias("operations"), when(L.portfolio_rules(joined), L.portfolio_rules(empty)).alias("portfolio_rules"), when(L.lessons(joined), L.lessons(empty)).alias("lessons"), L.signals(joined).alias("method_signals"),
        F.lit(captured_at).alias("captured_at"), F.col("role").alias("source_role"), a["status"].alias("transcript_status"), F.coalesce(a["quality"], F.lit("Q5")).alias("content_quality"), F.coalesce(a["provider"], F.lit("metadata_only")).alias("content_provider"),
        F.coalesce(a["provider_url"], blank).alias("content_provider_url"), F.coalesce(a["content_origin"], F.lit("metadata_only")).alias("content_origin"), F.coalesce(a["timestamp_evidence"], F.lit(False)).alias("timestamp_evidence"), (allowed & ~by_owner).alias("rule_candidate_allowed"),
        only(either, C.without_text(C.claims(joined, limit=CLAIMS))).alias("claims"), F.when(by_owner, UNVERIFIED).when(by_model, UNVALIDATED).alias("claims_status"), only(either, st["claims"]).alias("video_claims"), only(by_model, st["model"]).alias("video_claims_model"), only(by_model, st["macro"]).alias("video_macro"),
        only(by_model, F.substring(F.coalesce(st["observed_title"], blank), 1, 200)).alias("video_observed_title"), only(by_owner, st["submission_ids"]).alias("owner_submission_ids"), only(by_owner, st["summary_sha256"]).alias("owner_summary_sha256"), only(by_owner, F.lit(OWNER)).alias("evidence_mode"),
        only(either, F.lit(PENDING)).alias("validation_status"), only(either, F.lit(False)).alias("forward_evidence_eligible"), F.when(by_owner, owner_notice).when(by_model, model_notice).otherwise(notice).alias("source_notice"))


#: Grades that may be learned from, and attributions that are the author's own.
LEARNABLE, OWN = ("Q1", "Q2"), ("author_action", "author_plan")


def probes(df: DataFrame, noise: list[str], markers: list[str], now: str) -> DataFrame:
    """Archive rows of probed videos: ``df`` has author, role, video_id, title, text, quality, provider and content_origin.
    A provider's navigation page counts as the lowest grade; only the two best grades with a text are learned from, and
    of their operations only the author's own. Wording is not kept, and nothing is evidence."""
    blank = F.lit("")
    raw = F.coalesce("text", blank)
    plate = F.coalesce(X.boilerplate(raw, markers, 3, 2000), F.lit(False))
    rows = df.withColumns({"_plate": plate, "_clean": F.array_join(L.without_promotion(B.cleaned(raw, noise))["kept"], "\n")})
    rows = rows.withColumn("_quality", F.when(F.col("_plate"), "Q5").otherwise(F.coalesce(T.null_if_empty(F.col("quality")), F.lit("Q5"))))
    eligible = F.col("_quality").isin(*LEARNABLE) & (F.col("_clean") != "")
    # what isn't eligible is an empty text to all rules
    rows = rows.withColumns({"_eligible": eligible, "_learn": F.when(eligible, F.col("_clean"))})
    learn, seen = F.col("_learn"), F.col("_clean")
    quiet = (F.col("role") == "market_context") & ~F.contains(F.lower(seen), F.lit("servicenow")) & ~F.contains(seen, F.lit("$NOW"))
    own = F.filter(L.operations(learn), lambda o: o["attribution"].isin(*OWN))
    names = F.filter(_symbols(F.coalesce(learn, blank)), lambda s: ~(F.coalesce(quiet, F.lit(False)) & (s == "NOW")))
    claims = C.without_text(C.claims(learn, limit=CLAIMS))
    none = F.array().cast("array<string>")
    return rows.select(
        F.concat(F.lit("yt_hist_"), F.substring(F.sha2(F.coalesce("video_id", blank), 256), 1, 16)).alias("archive_id"), "author", "video_id", "title", "role", F.concat(F.lit("https://www.youtube.com/watch?v="), F.coalesce("video_id", blank)).alias("url"),
        F.col("_quality").alias("quality"), "provider", "content_origin", F.col("_eligible").alias("historical_learning_eligible"), F.length(seen).cast("long").alias("text_chars_seen"), F.when(seen != "", F.sha2(seen, 256)).alias("text_hash"), F.lit("").alias("excerpt"),
        names.alias("symbols"), F.when(F.col("_eligible"), L.themes(F.concat_ws("\n", F.coalesce("title", blank), learn))).otherwise(none).alias("themes"), F.when(F.col("_eligible"), B.topics(learn, B.MACRO)).otherwise(none).alias("macro_topics"), own.alias("operations"),
        L.portfolio_rules(learn).alias("portfolio_rules"), L.lessons(learn).alias("lessons"), none.alias("representative_points"), claims.alias("claims"), F.size(F.filter(claims, X.checkable)).alias("checkable_claims"), F.col("_plate").alias("provider_boilerplate"),
        *(F.lit(False).alias(c) for c in ("forward_evidence_eligible", "promotion_eligible", "event_score_eligible")), F.lit(now).alias("last_probe_at"))
