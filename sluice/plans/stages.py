"""Stages and extension points over the given tables: cleaning, validators, models, generators, checkpoints, and reports that are counted as they are written."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import PROMPT_SUFFIX
from sluice.operators import report
from sluice.operators.quality import MIN_HEIGHT, MIN_WIDTH, SHARPNESS, Thresholds
from sluice.operators.surfaces import ExpressionValidator, embed, generate, validate
from sluice.plans.curation import QUERY_FATES, fates
from sluice.plans.pipeline import Cleaning, clean_images, clean_videos
from sluice.plans.registry import query
from sluice.plans.sequences import CHANGE
from sluice.session import shared_folder, table
from sluice.sources.lists import Checkpoint

T = Thresholds()

_FEATURES = """
    select coalesce(source, 'none') || '/' || doc_id || '.jpg' as path, case when n_chars % 37 <> 0 then n_chars end as width, 200 + doc_id % 1200 as height,
      (n_chars % 900)::double as lap_var, (doc_id % 101) / 100.0::double as blue, (n_chars % 53) / 1000.0::double as edges from documents"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pictures: their sizes and measures are numbers of theirs."""
    chars, doc = F.col("n_chars"), F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), doc.cast("string"), F.lit(".jpg")).alias("path"),
        F.when(chars % 37 != 0, chars).alias("width"),
        (200 + doc % 1200).alias("height"),
        (chars % 900).cast("double").alias("lap_var"),
        ((doc % 101) / 100).alias("blue"),
        ((chars % 53) / 1000).alias("edges"),
    )


@query(
    "cleaned_pictures",
    f"""with f as ({_FEATURES})
    select path, replace(path, '/', '_') as name, case when width is null then 'unreadable' when width < {MIN_WIDTH} or height < {MIN_HEIGHT} then 'low_res'
      when lap_var < {SHARPNESS} or lap_var is null then 'blur'
      when greatest(width, height) / least(width, height) > {T.max_aspect} or blue < {T.min_blue} or blue > {T.max_blue} or edges < {T.min_edges} then 'invalid' else 'kept' end as fate from f""",
)
def cleaned_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clean_images(features(spark, sf_dir), Cleaning(deduplicate=False, validate=True))
    return found.select("path", "name", "fate")


@query(
    "cleaned_videos",
    f"""with e as (select label, vec_id, i, embedding[i + 1]::double as x from embeddings, (select unnest(range(64)) as i)),
    l as (select *, lag(x) over (partition by label, i order by vec_id) as y from e),
    k as (select label, vec_id, count(y) = 0 or (1 - corr(x, y)) * 100 > {CHANGE} as is_key from l group by label, vec_id),
    o as (select label, vec_id, row_number() over (partition by label order by vec_id) - 1 as ordinal from k where is_key)
    select 'v' || label as video, vec_id, ordinal::bigint as ordinal, printf('v%d_frame_%05d.jpg', label, ordinal) as name from o where vec_id * 7 % 300 >= {SHARPNESS}""",
)
def cleaned_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label are a video's frames; a frame that isn't sharp goes, but has had its number."""
    frames = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("v"), F.col("label").cast("string")).alias("video"), F.col("vec_id").alias("frame_idx"), F.col("embedding").cast("array<double>").alias("hist"), (F.col("vec_id") * 7 % 300).cast("double").alias("lap_var")
    )
    return clean_videos(frames, Cleaning(scene_change=CHANGE)).select("video", F.col("frame_idx").alias("vec_id"), F.col("ordinal").cast("long").alias("ordinal"), "name")


@query(
    "validated_documents",
    """select doc_id, case when text is null or length(text) < 200 then 'length' when quality is distinct from 1 then 'quality' when toxic <> 0 then 'toxic' end as failed_check,
      case when length(text) >= 200 then quality end as seen_quality, coalesce(length(text) >= 200 and quality = 1 and toxic = 0, false) as valid
    from documents left join labels using (doc_id)""",
)
def validated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.char_length("text").alias("chars")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    checks = [
        ExpressionValidator("length", lambda: F.col("chars") >= 200),
        ExpressionValidator("quality", lambda: F.col("quality") == 1, lambda: {"seen_quality": F.col("quality")}),
        ExpressionValidator("toxic", lambda: F.col("toxic") == 0),
    ]
    return validate(docs, checks).select("doc_id", "failed_check", "seen_quality", "valid")


def _counts():
    """A model of three numbers of a text; it fails on what isn't a text."""
    return lambda texts: [[float(len(t)), float(t.count(" ")), float(t.count("e"))] for t in texts]


@query(
    "embedded_turns",
    """select conv_id, turn, length(text)::double as chars, (length(text) - length(replace(text, ' ', '')))::double as blanks, (length(text) - length(replace(text, 'e', '')))::double as es from conversations""",
)
def embedded_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embed(table(spark, sf_dir, "conversations"), "text", lambda: _counts())
    return found.select("conv_id", "turn", *(F.get("embedding", F.lit(k)).alias(n) for k, n in enumerate(("chars", "blanks", "es"))))


@query(
    "generated_files",
    f"""select p_partkey::int as idx, p_name as prompt, printf('synthetic_%05d.png', p_partkey) as name, case when p_name not like 'a%' then md5(p_name || '{PROMPT_SUFFIX}') end as digest from part""",
)
def generated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generator answers with what it was asked, and fails whenever that begins with an a."""

    def load():
        def answer(asked: str) -> bytes:
            if asked.startswith("a"):
                raise OSError(asked)
            return asked.encode()

        return answer

    prompts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("idx"), F.col("p_name").alias("prompt"))
    return generate(prompts, load).select("idx", "prompt", "name", F.md5("content").alias("digest"))


@query(
    "checkpointed_items",
    """select 'users' as task_name, user_id::varchar as item_id from events where user_id is not null group by 2
    union all select 'kinds', event_type from events where event_type is not null group by 2""",
)
def checkpointed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users are added twice, first those with an error, and merged; another task's items stay apart."""
    events = table(spark, sf_dir, "events")
    done = Checkpoint(spark, f"{shared_folder(spark).rstrip('/')}/sluice-{uuid.uuid4().hex}", most_batches=1)
    atexit.register(done.discard)
    done.add("kinds", events, "event_type")
    for some in (events.where("event_type = 'error'"), events):
        done.add("users", some, "user_id")
    return done.load().select("task_name", "item_id")


@query(
    "written_funnel",
    f"""with {QUERY_FATES}, c as (
      select count(*) as total, count(*) filter (where fate <> 'low_res') as processed, count(*) filter (where fate = 'low_res') as removed_low_res,
        0::bigint as removed_blur, count(*) filter (where fate = 'duplicate') as removed_duplicates,
        count(*) filter (where fate = 'invalid') as removed_validation, count(*) filter (where fate = 'kept') as final from fates)
    select 'images' as section, metric, value from (unpivot c on columns(*) into name metric value value)""",
)
def written_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel of ``funnel_report``, counted while the fates are written."""
    _, counts = report.stored_with_funnel(fates(spark, sf_dir))
    return report.long_form(counts, "images")
