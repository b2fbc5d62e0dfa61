"""One registered query per operator. Each reads the tables of a folder, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions import sender_rules as sr
from baitline.functions.html import page_title
from baitline.functions.strings import clean_text
from baitline.operators import (
    alerts, attachments, captures, datasets, features, intake, metrics, models, pages, patterns,
    permutation, policy, risk, sampling, senders, text, urls,
)
from baitline.plans.scoring import score_emails, url_benchmark
from baitline.plans.scale import micros_of, shared_folder
from baitline.sources import readers, writers
from baitline.sources.readers import parse_domains, parse_feed
from baitline.streaming import jobs, latest_log
from baitline.workload import views as v

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore is left out."""
    REGISTRY[fn.__name__.rstrip("_")] = fn
    return fn


def joined(column: str) -> Column:
    return F.array_join(column, " ; ").alias(column.split(".")[-1])


def flat(verdicts: DataFrame, *more: str) -> DataFrame:
    """Verdicts without nested columns."""
    return verdicts.select(
        "email_id", *more, "risk_score", "risk_level", joined("reasons"),
        *[F.col(f"indicators.{i}").alias(f"{i}_score") for i in risk.INDICATORS],
        "recommended_action")


# --- intake and clean-up ------------------------------------------------------------

@query
def intake_errors(spark, sf):
    _, bad = intake.validate_emails(v.raw_json(spark, sf))
    return bad.select("email_id", joined("errors"))


@query
def raw_emails_file(spark, sf):
    """JSON lines written as text and read back before they are checked."""
    path = f"{shared_folder(spark)}/mails.json"
    v.raw_json(spark, sf).select("raw").write.text(path)
    _, bad = intake.validate_emails(readers.read_raw_emails(spark, path))
    return bad.groupBy(joined("errors")).agg(F.count(F.lit(1)).alias("n"))


@query
def pages_file(spark, sf):
    held = pages.pages_to_emails(readers.read_pages(spark, f"{sf}/pages.parquet"))
    return held.select("email_id", "sender_email", "subject", F.md5("body_text").alias("body_md5"))


@query
def intake_published(spark, sf):
    """Accepted and rejected mails made visible together, and read back."""
    good, bad = intake.validate_emails(v.raw_json(spark, sf))
    path = shared_folder(spark)
    writers.publish({"accepted": good.select("email_id"), "rejected": bad.select("email_id", joined("errors"))}, path)
    return writers.read_published(spark, path, "rejected").unionByName(
        writers.read_published(spark, path, "accepted").withColumn("errors", F.lit("")))


@query
def intake_valid(spark, sf):
    good, _ = intake.validate_emails(v.raw_json(spark, sf))
    held = intake.normalize_emails(good)
    first = F.get("attachments", F.lit(0))
    return held.select(
        "email_id", "sender_email", "sender_name", "subject", "body_text",
        F.array_join("urls", " ").alias("urls"), F.size("attachments").alias("n_files"),
        first["extension"].alias("extension"), first["size_kb"].alias("size_kb"))


@query
def emails_normalized(spark, sf):
    held = intake.normalize_emails(v.emails(spark, sf))
    return held.select("email_id", "sender_email", "sender_name", F.array_join(F.transform(
        "attachments", lambda a: a["extension"]), " ").alias("extensions"))


@query
def clean_text_(spark, sf):
    """The limits as an option: subject and body cut."""
    held = text.clean_emails(v.emails(spark, sf), fv.SUBJECT_CHARS, fv.BODY_CHARS)
    return held.select("email_id", "subject", F.length("body_text").alias("n_chars"),
                       F.md5("body_text").alias("body_md5"))


@query
def clean_whole_text(spark, sf):
    return v.table(spark, sf, "documents").select(
        "doc_id", F.md5(clean_text(F.col("text"))).alias("text_md5"))


@query
def urls_deduped(spark, sf):
    held = urls.dedupe_urls(v.emails(spark, sf))
    return held.select("email_id", F.array_join("urls", " ").alias("urls"),
                       F.size("urls").alias("n_urls"))


@query
def url_lines(spark, sf):
    return datasets.url_lines(v.url_lines_raw(spark, sf))


@query
def url_parts(spark, sf):
    lines = datasets.url_lines(v.url_lines_raw(spark, sf))
    return urls.url_parts(lines).withColumn("is_ip", F.col("is_ip").cast("int"))


@query
def sender_domains(spark, sf):
    held = senders.with_sender_domain(v.emails(spark, sf))
    return held.select("email_id", "sender_domain",
                       sr.policy_domain(F.col("sender_email")).alias("policy_domain"))


@query
def extract_sender(spark, sf):
    headers = v.mail(spark, sf).select("email_id", F.concat_ws(
        "", F.lit('"'), "sender_name", F.lit('" <'), "sender_email", F.lit(">")).alias(
        "from_header"))
    return senders.extract_sender(headers).select("email_id", "sender_email", "sender_name")


@query
def feed_parse(spark, sf):
    raw = v.mail(spark, sf).select(F.concat_ws(
        ", ", F.upper("sender_email"), "urls_joined", F.lit("\n\nc.org,,a.com ")).alias("value"))
    return parse_feed(raw)


@query
def policy_parse(spark, sf):
    raw = v.mail(spark, sf).select(F.concat_ws(
        " , ", F.upper("sender_email"), F.lit(""), "sender_name").alias("value"))
    return parse_domains(raw, "block")


# --- indicators ----------------------------------------------------------------------

@query
def text_chunks(spark, sf):
    held = text.text_chunks(text.clean_emails(v.emails(spark, sf)))
    return held.select("email_id", "pos", F.length("chunk").alias("n_chars"),
                       F.md5("chunk").alias("chunk_md5"))


@query
def keyword_scores(spark, sf):
    scored = text.keyword_scores(text.text_chunks(v.emails(spark, sf)))
    return scored.select("email_id", "pos",
                         F.round(F.col("chunk_score").cast("decimal(18,9)"), 6).cast("double")
                         .alias("chunk_score"))


def _text(spark, sf, aggregation, **limits):
    held = text.score_text(text.clean_emails(v.emails(spark, sf), **limits), aggregation)
    return held.select("email_id", "text_score", joined("text_reasons"), "chunk_count",
                       "text_aggregation", "text_mode")


@query
def text_scores(spark, sf):
    return _text(spark, sf, "mean")


@query
def text_scores_max(spark, sf):
    return _text(spark, sf, "max")


@query
def text_scores_whole(spark, sf):
    """The default, with both limits spelled out as absent."""
    return _text(spark, sf, "mean", subject_chars=None, body_chars=None)


@query
def url_findings(spark, sf):
    found = urls.url_findings(urls.dedupe_urls(v.emails(spark, sf)))
    return found.select("email_id", "pos", "url", "host", "points", joined("reasons"))


@query
def url_scores(spark, sf):
    held = urls.score_urls(urls.dedupe_urls(v.emails(spark, sf)))
    return held.select("email_id", "url_score", joined("url_reasons"), "url_count")


@query
def url_scores_table_feed(spark, sf):
    """Feeds as tables derived from the mail itself: join path when they are long."""
    mail = v.emails(spark, sf)
    hosts = urls.url_parts(urls.explode_urls(mail)).filter("host <> ''")
    feeds = urls.Feeds(
        domains=hosts.filter(~F.col("is_ip")).filter("host LIKE '%secure-%'")
        .select(F.col("host").alias("domain")).distinct(),
        ips=hosts.filter("is_ip").select(F.col("host").alias("ip")).distinct())
    held = urls.score_urls(urls.dedupe_urls(mail), feeds)
    return held.select("email_id", "url_score", "url_count")


@query
def url_scores_long_feed(spark, sf):
    """A feed far longer than what occurs in the mails: most entries meet nothing."""
    mail = v.emails(spark, sf)
    hosts = urls.url_parts(urls.explode_urls(mail)).filter("host <> ''")
    others = [v.table(spark, sf, t).select(F.concat(F.lit(f"{t}-"), F.col(i).cast("string"), F.lit(".example"))
                                           .alias("domain")) for t, i in (("events", "event_id"), ("documents", "doc_id"))]
    listed = hosts.filter("NOT is_ip AND host LIKE '%secure-%'").select(F.col("host").alias("domain"))
    feeds = urls.Feeds(domains=listed.union(others[0]).union(others[1]),
                       ips=hosts.filter("is_ip").select(F.col("host").alias("ip")))
    held = urls.score_urls(urls.dedupe_urls(mail), feeds)
    return held.select("email_id", "url_score", "url_count")


@query
def url_reputation(spark, sf):
    return urls.match_reputation(urls.explode_urls(v.emails(spark, sf)))


@query
def brand_mismatch(spark, sf):
    return senders.brand_mismatch(v.emails(spark, sf))


@query
def brand_table_mismatch(spark, sf):
    brands = v.mail(spark, sf).select(F.lower(F.split("sender_name", " ")[0]).alias("brand")
                                      ).filter("brand IS NOT NULL").distinct()
    brands = brands.select(F.lit(0).alias("ord"), "brand", F.initcap("brand").alias("title"),
                           F.concat("brand", F.lit(".com")).alias("expected_domain"))
    return senders.claimed_brands(v.emails(spark, sf), brands).select("email_id", "title")


@query
def keyword_table_hits(spark, sf):
    """Texts against a table of all first words, each text read once."""
    docs = v.table(spark, sf, "documents").select("doc_id", F.lower("text").alias("text"))
    words = docs.select(F.split("text", " ")[0].alias("pattern"))
    return patterns.pattern_counts(docs, words, "doc_id")


@query
def sender_scores(spark, sf):
    held = senders.score_senders(intake.normalize_emails(v.emails(spark, sf)))
    return held.select("email_id", "sender_domain", "sender_score", joined("sender_reasons"))


@query
def attachment_scores(spark, sf):
    held = attachments.score_attachments(v.emails(spark, sf))
    return held.select("email_id", "attachment_score", joined("attachment_reasons"),
                       "attachment_count")


# --- verdicts, policy, alerts --------------------------------------------------------

@query
def risk_verdicts(spark, sf):
    """Four separate indicator tables put together."""
    mail = urls.dedupe_urls(text.clean_emails(intake.normalize_emails(v.emails(spark, sf))))

    def part(scored: DataFrame, name: str) -> DataFrame:
        return scored.select("email_id", F.col(f"{name}_score").alias("score"),
                             F.col(f"{name}_reasons").alias("reasons"))

    return flat(risk.combine_scores(
        part(text.score_text(mail), "text"), part(urls.score_urls(mail), "url"),
        part(senders.score_senders(mail), "sender"),
        part(attachments.score_attachments(mail), "attachment")))


@query
def score_emails_(spark, sf):
    return flat(score_emails(v.emails(spark, sf)))


@query
def policy_verdicts(spark, sf):
    return flat(score_emails(v.emails(spark, sf), policy=v.policy(spark)))


@query
def manual_verdicts(spark, sf):
    scored = score_emails(v.emails(spark, sf), keep=("sender_email",))
    listed = policy.with_policy(scored, v.policy(spark))
    return policy.manual_verdict(listed).select("email_id", "risk_score", "risk_level",
                                                joined("reasons"), "recommended_action")


@query
def badges(spark, sf):
    return alerts.badge(score_emails(v.emails(spark, sf))).select(
        "email_id", "risk_level", "badge_text", "badge_color")


_SHOWN = ("page_source", "subject", "sender_name", "sender_email")


@query
def alerts_(spark, sf):
    due = alerts.alert_rows(score_emails(v.emails(spark, sf), keep=_SHOWN))
    return due.select("email_id", "title", "message", "priority",
                      F.col("sticky").cast("int").alias("sticky"))


def _visited(spark, sf, events=None):
    scored = score_emails(v.emails(spark, sf), keep=_SHOWN + ("body_text", "urls"))
    printed = captures.fingerprint(scored).drop("body_text", "urls", "indicators")
    return v.visited_verdicts(spark, sf, printed, events)


@query
def alerts_deduped(spark, sf):
    due = alerts.with_alert_key(alerts.alert_rows(_visited(spark, sf)))
    kept = alerts.suppress_repeat_alerts(
        due.select("tab", "ts", "seq", "email_id", "title", "alert_key"))
    return kept.select("tab", "seq", v.ts_us(kept), "email_id", "title", "alert_key")


@query
def latest_verdict(spark, sf):
    last = alerts.latest_analysis(_visited(spark, sf).filter("tab IS NOT NULL"))
    return last.select("tab", "seq", v.ts_us(last), "email_id", "risk_score",
                       "risk_level")


# --- pages and captures --------------------------------------------------------------

@query
def pages_to_emails(spark, sf):
    held = pages.pages_to_emails(v.table(spark, sf, "pages"))
    return held.select("email_id", "sender_email", "sender_name", "subject",
                       F.length("body_text").alias("n_chars"), F.md5("body_text").alias("body_md5"),
                       F.array_join("urls", " ").alias("urls"), "page_source")


@query
def mail_view_to_emails(spark, sf):
    """Pages as opened mails: their HTML is the body, their links count when absolute."""
    views = v.table(spark, sf, "pages").select(
        F.col("page_id").alias("email_id"), page_title(F.col("html")).alias("subject"),
        F.concat(F.lit(" Team "), F.col("page_id").cast("string")).alias("from_name"),
        F.when(F.col("page_id") % 3 > 0, F.concat(F.lit("<Box@"), F.split("url", "/")[2],
                                                  F.lit(">"))).alias("from_addr"),
        F.concat("html", F.lit('<a class="x" href="'), "url", F.lit('">more</a>')).alias(
            "body_html"),
        F.when(F.col("page_id") % 2 == 0, F.array(F.lit(" Page.PDF.Zip "), F.lit(""), F.lit("LOG")))
        .otherwise(F.array().cast("array<string>")).alias("files"))
    held = pages.mail_view_to_emails(views)
    return held.select("email_id", "sender_email", "sender_name", "subject",
                       F.md5("body_text").alias("body_md5"), F.array_join("urls", " ").alias("urls"),
                       F.array_join(F.transform("attachments", lambda a: a["extension"]), "|")
                       .alias("extensions"), F.size("attachments").alias("n_files"))


@query
def page_verdicts(spark, sf):
    """Pages scored end to end."""
    return flat(score_emails(pages.pages_to_emails(v.table(spark, sf, "pages"))))


@query
def capture_filter(spark, sf):
    kept = captures.capture_filter(v.emails(spark, sf))
    return kept.select("email_id", "page_source")


@query
def fingerprint(spark, sf):
    of_pages = captures.fingerprint(pages.pages_to_emails(v.table(spark, sf, "pages")))
    of_mail = captures.fingerprint(v.emails(spark, sf))
    return (of_pages.select(F.lit("page").alias("kind"), "email_id", "fingerprint")
            .unionByName(of_mail.select(F.lit("mail").alias("kind"), "email_id", "fingerprint")))


@query
def capture_changes(spark, sf):
    kept = captures.drop_consecutive_duplicates(v.page_captures(spark, sf))
    return kept.select("tab", "seq", v.ts_us(kept), "page_id", "fingerprint")


@query
def debounced_captures(spark, sf):
    events = v.table(spark, sf, "events").select(
        F.col("user_id").alias("tab"), "ts", F.col("event_id").alias("seq"), "event_type")
    last = captures.debounce(events, gap=v.GAP)
    return last.select("tab", "seq", v.ts_us(last), "event_type")


# --- data sets -----------------------------------------------------------------------

@query
def text_urls(spark, sf):
    mails = v.mail(spark, sf).select("email_id", F.concat_ws(" ", "body_text", "urls_joined")
                                     .alias("t"))
    return mails.select("email_id", F.array_join(datasets.text_urls(F.col("t")), " ").alias("urls"),
                        datasets.joined_set(datasets.text_urls(F.col("t")), 20).alias("url_set"))


@query
def mail_archive(spark, sf):
    rows = datasets.mail_to_training(datasets.decode_mail(v.mail_files(spark, sf)))
    return rows.select("path", "sender_email", "sender_name", "subject",
                       F.md5("body_text").alias("body_md5"), "urls", "attachments", "label")


def _without_path(rows: DataFrame) -> DataFrame:
    return rows.select("sender_email", "sender_name", "subject", F.md5("body_text").alias("body_md5"),
                       "urls", "attachments", "label")


@query
def mail_boxes(spark, sf):
    """Real mailboxes, read in splits of a megabyte."""
    good, _ = readers.read_mail_archive_checked(spark, v.mail_boxes(spark, sf), split_bytes=1 << 20)
    return _without_path(good)


@query
def mail_rejected(spark, sf):
    _, bad = readers.read_mail_archive_checked(spark, v.mail_boxes(spark, sf), split_bytes=1 << 20)
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_mail(spark, sf):
    """The same mailboxes as an arriving stream."""
    arriving = readers.read_mail_archive_stream(spark, v.mail_boxes(spark, sf), settle_seconds=0)
    out = shared_folder(spark)
    jobs.drain(spark, lambda: jobs.to_folder(arriving, f"{out}/rows", f"{out}/mark", once=True))
    return _without_path(spark.read.parquet(f"{out}/rows"))


@query
def benign_urls(spark, sf):
    index = v.table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return datasets.benign_urls(index)


@query
def benign_emails(spark, sf):
    index = v.table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return datasets.benign_emails(index)


@query
def url_sample(spark, sf):
    lines = datasets.url_lines(v.url_lines_raw(spark, sf))
    return sampling.seeded_sample(lines, lines.count() // 2)


@query
def url_testset(spark, sf):
    n = v.table(spark, sf, "documents")
    index = n.select(F.col("doc_id").alias("id"))
    lines = datasets.url_lines(v.url_lines_raw(spark, sf))
    return datasets.build_url_testset(lines, n.count(), 0, good_index=index)


@query
def training_set(spark, sf):
    mail = v.training_rows(spark, sf).filter("label = 1")
    return datasets.build_training_set(spark, mail, 0.5).select(
        "sender_email", "sender_name", "subject", F.md5("body_text").alias("body_md5"), "urls",
        "attachments", "label")


@query
def training_csv(spark, sf):
    """The training table written as CSV and read back, line breaks and all."""
    path = f"{shared_folder(spark)}/training.csv"
    writers.write_training_csv(v.training_rows(spark, sf), path)
    return readers.read_training_csv(spark, path, "tagged").select(
        "sender_email", "sender_name", "subject", F.md5("body_text").alias("body_md5"), "urls", "attachments",
        "label", F.md5("text").alias("text_md5"))


@query
def labelled_urls_csv(spark, sf):
    """URLs with labels to CSV and back, scored, and the predictions to CSV and back."""
    folder = shared_folder(spark)
    urls_of = v.mail(spark, sf).select(F.explode(F.split("urls_joined", " ")).alias("url"), F.expr(v.LABEL_SQL)
                                       .cast("int").alias("y_true"))
    writers.write_url_testset(urls_of.filter("url <> ''"), f"{folder}/testset.csv")
    held = readers.read_labelled_urls(spark, f"{folder}/testset.csv")
    writers.write_url_predictions(urls.score_url_table(held), f"{folder}/predictions.csv")
    found = readers.read_predictions(spark, f"{folder}/predictions.csv")
    return found.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


@query
def eval_template_csv(spark, sf):
    """The template to fill with predictions, as written and read back."""
    path = f"{shared_folder(spark)}/template.csv"
    lines = datasets.url_lines(v.url_lines_raw(spark, sf))
    writers.write_eval_template(lines.withColumn("y_true", F.lit(1)), path)
    return readers.read_csv(spark, path).select("url", F.col("y_true").cast("int").alias("y_true"),
                                                F.col("y_pred").cast("int").alias("y_pred"))


@query
def metrics_json(spark, sf):
    path = f"{shared_folder(spark)}/metrics.json"
    held = binary_metrics(spark, sf)
    writers.write_metrics_json(held, path)
    return spark.read.schema(held.schema).json(path)


@query
def shuffled_rows(spark, sf):
    """The place of every row in the seeded order."""
    held = sampling.shuffle_rows(v.training_rows(spark, sf).select("id", "label"), "id")
    path = f"{shared_folder(spark)}/rows"
    held.withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    before = F.count(F.lit(1)).over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    return spark.read.parquet(path).select("id", "label", before.alias("place"))


@query
def permuted_rows(spark, sf):
    """All documents in the seeded order that is computed from their row numbers."""
    return permutation.permuted_files(spark, f"{sf}/documents.parquet").select("doc_id", "place")


@query
def tfidf_features(spark, sf):
    """Per text: terms of the vocabulary it holds, and its weights summed by the terms' places."""
    texts = features.training_text(v.training_rows(spark, sf))
    held = models.fit_text_features(texts, 300).transform(texts.select("id", "text"))
    values = vector_to_array("tfidf")
    at = F.aggregate(F.transform(values, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return held.select("id", F.size(F.filter(values, lambda x: x > 0)).alias("n_terms"),
                       F.round(F.array_max(values), 6).alias("largest"), F.round(at, 4).alias("by_place"))


@query
def stratified_split(spark, sf):
    return sampling.stratified_split(v.training_rows(spark, sf)).select("id", "label", "part")


@query
def balanced_head(spark, sf):
    rows = v.training_rows(spark, sf)
    return sampling.balanced_head(rows, fv.BALANCED_ROWS).select("id", "label")


@query
def training_text(spark, sf):
    rows = v.training_rows(spark, sf)
    tagged = features.training_text(rows, "tagged").select("id", F.col("text").alias("tagged"))
    classic = features.training_text(rows).select("id", F.col("text").alias("classic"))
    return (tagged.select("id", F.lit("tagged").alias("layout"), F.md5("tagged").alias("text_md5"))
            .unionByName(classic.select("id", F.lit("classic").alias("layout"),
                                        F.md5("classic").alias("text_md5"))))


@query
def hand_features(spark, sf):
    return features.hand_features(v.training_rows(spark, sf)).select(
        "id", *models.HAND_FEATURES)


@query
def class_weights(spark, sf):
    held = features.class_weights(v.training_rows(spark, sf))
    return held.select("label", "n_rows", F.round(F.col("weight").cast("decimal(18,9)"), 6)
                       .cast("double").alias("weight"))


@query
def ngram_vocabulary(spark, sf):
    return features.ngram_vocabulary(features.training_text(v.training_rows(spark, sf)))


# --- evaluation and models -----------------------------------------------------------

@query
def url_predictions(spark, sf):
    lines = datasets.url_lines(v.url_lines_raw(spark, sf))
    return urls.score_url_table(lines.withColumn("y_true", F.lit(1)))


@query
def binary_metrics(spark, sf):
    pairs = v.table(spark, sf, "labels").select(F.col("toxic").alias("y_true"),
                                                (1 - F.col("quality")).alias("y_pred"))
    return metrics.binary_metrics(pairs)


@query
def url_benchmark_metrics(spark, sf):
    n = v.table(spark, sf, "documents").count()
    return url_benchmark(datasets.url_lines(v.url_lines_raw(spark, sf)), n, n)


def _trained(spark, sf, with_hand_features=True):
    rows = features.training_text(v.training_rows(spark, sf))
    split = sampling.stratified_split(rows)
    train = split.filter("part = 'train'")
    return models.train_classifier(train, with_hand_features), split


@query
def train_metrics(spark, sf):
    model, split = _trained(spark, sf)
    return models.evaluate_model(split.filter("part = 'validation'"), model)


@query
def model_text_scores(spark, sf):
    model, _ = _trained(spark, sf, with_hand_features=False)
    scored = models.score_text_with_model(text.clean_emails(v.emails(spark, sf)), model)
    return scored.select("email_id", "text_score", joined("text_reasons"), "chunk_count",
                         "text_aggregation", "text_mode")


@query
def function_text_scores(spark, sf):
    """A user's own model, called in batches: here the logit grows with the share of '!'."""
    def load():
        import numpy as np

        def predict(texts):
            share = np.array([t.count("!") / max(1, len(t)) for t in texts], dtype="float64")
            return np.stack([np.zeros_like(share), 40.0 * share - 1.0], axis=1)
        return predict

    scored = models.score_text_with_fn(text.clean_emails(v.emails(spark, sf)), load, "max")
    return scored.select("email_id", "text_score", "chunk_count", "text_mode")


# --- streams: the tables arrive as files, results are read back from the sink ---------

def _folder(spark: SparkSession) -> str:
    return shared_folder(spark)


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    # The trigger bounds how many rows of a busy tab one micro-batch can hold.
    return (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", 1000).parquet(sf))


def _drained(spark: SparkSession, df: DataFrame, mode: str = "append") -> DataFrame:
    folder = _folder(spark)
    jobs.drain(spark, lambda: jobs.to_folder(df, f"{folder}/out", f"{folder}/checkpoint", mode, once=True))
    return spark.read.parquet(f"{folder}/out")


@query
def stream_scores(spark, sf):
    """JSON texts arriving as files, checked and scored."""
    jobs.use_stream_settings(spark)
    folder = _folder(spark)
    v.raw_json(spark, sf).select("email_id", "raw").write.parquet(f"{folder}/in")
    raw = spark.readStream.schema("email_id bigint, raw string").parquet(f"{folder}/in")
    jobs.drain(spark, lambda: jobs.stream_score_emails(
        raw, f"{folder}/verdicts", f"{folder}/rejected", f"{folder}/checkpoint", once=True))
    good = spark.read.parquet(f"{folder}/verdicts").select("email_id", "risk_score", joined("reasons"))
    bad = spark.read.parquet(f"{folder}/rejected").select(
        "email_id", F.lit(None).cast("double").alias("risk_score"),
        F.array_join("errors", " ; ").alias("reasons"))
    return good.unionByName(bad)


@query
def stream_debounce(spark, sf):
    """Bursts that have ended by the watermark; an unfinished one is not reported."""
    jobs.use_stream_settings(spark)
    events = _events_stream(spark, sf)
    captures = events.select(
        F.col("user_id").alias("tab"), F.timestamp_micros(micros_of(events, "ts")).alias("ts"),
        F.col("event_id").alias("seq"), "event_type")
    last = _drained(spark, jobs.stream_debounce(captures, gap=v.GAP))
    return last.select("tab", "seq", v.ts_us(last), "event_type")


@query
def stream_changes(spark, sf):
    jobs.use_stream_settings(spark)
    kept = _drained(spark, jobs.stream_changes(
        v.page_captures(spark, sf, _events_stream(spark, sf))))
    return kept.select("tab", "seq", v.ts_us(kept), "page_id", "fingerprint")


LATE_MICROS = 2 * 86400 * 1000000


@query
def stream_changes_late(spark, sf):
    """Captures that arrive up to two days late, in four parts, the stream restarted after each."""
    jobs.use_stream_settings(spark)
    events, folder = v.table(spark, sf, "events"), _folder(spark)
    micros = micros_of(events, "ts")
    arrival = micros + F.pmod(F.xxhash64("event_id"), F.lit(LATE_MICROS))
    held = events.select("event_id", "user_id", F.timestamp_micros(micros).alias("ts"), arrival.alias("arrival"))
    low, high = held.agg(F.min("arrival"), F.max("arrival")).first()
    part = F.floor((F.col("arrival") - low) * 4 / (high - low + 1))
    for k in range(4):
        held.filter(part == k).select("event_id", "user_id", "ts").write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema("event_id bigint, user_id bigint, ts timestamp").parquet(f"{folder}/in")
        kept = jobs.stream_changes(v.page_captures(spark, sf, arriving), delay=f"{LATE_MICROS} microseconds")
        jobs.drain(spark, lambda: jobs.to_folder(kept, f"{folder}/out", f"{folder}/checkpoint", once=True))
    out = spark.read.parquet(f"{folder}/out")
    return out.select("tab", "seq", v.ts_us(out), "page_id", "fingerprint")


@query
def stream_alerts(spark, sf):
    jobs.use_stream_settings(spark)
    due = alerts.alert_rows(_visited(spark, sf, _events_stream(spark, sf)))
    kept = _drained(spark, jobs.stream_alerts(
        due.select("tab", "ts", "seq", "email_id", "title", "subject", "fingerprint", "risk_level")))
    return kept.select("tab", "seq", v.ts_us(kept), "email_id", "title", "alert_key")


@query
def stream_latest(spark, sf):
    jobs.use_stream_settings(spark)
    seen = _visited(spark, sf, _events_stream(spark, sf)).filter("tab IS NOT NULL").select(
        "tab", "ts", "seq", "email_id", "risk_score", "risk_level")
    last = jobs.newest_per_key(_drained(spark, jobs.stream_latest(seen), "update"))
    return last.select("tab", "seq", v.ts_us(last), "email_id", "risk_score", "risk_level")


@query
def stream_latest_log(spark, sf):
    """Captures in four parts, the stream restarted after each, tabs forgotten at once, the log merged twice."""
    jobs.use_stream_settings(spark)
    events, folder = v.table(spark, sf, "events"), _folder(spark)
    for k in range(4):
        part = events.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k)
        part.write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        seen = v.page_captures(spark, sf, arriving).select("tab", "ts", "seq", "page_id", "fingerprint")
        jobs.drain(spark, lambda seen=seen: latest_log.stream_latest_log(
            seen, f"{folder}/log", f"{folder}/checkpoint", forget_ms=1, compact_every=2, once=True))
    last = latest_log.read_latest(spark, f"{folder}/log")
    return last.select("tab", "seq", v.ts_us(last), "page_id", "fingerprint")
