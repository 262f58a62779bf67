"""The whole build: chat export -> conversation dataset (what the reference's
preprocessing does), as one lazy DataFrame plan with two materialisation
points: the bronze message table (lineage cut, prunable parquet) and the
dataset itself.

    export --decode--> bronze --F1/F2, T8--> valid (J1 is dead: not joined)
      --W1-W4/F11--> grouped --T1-T6--> cleaned --A1/W5/N1/N2--> conversations
      --F13/N3/N4/F14/F15--> examples --X1--> split --K1--> dataset (+K2, K3, A3)

Counters (A3) are gathered with ``DataFrame.observe`` during the dataset
write, so they cost no extra pass.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.tokens import TokenCounter, octet_proxy
from threadloom.operators import conversations, examples, filters, split
from threadloom.operators.sessionize import DEFAULT_BUCKET_SECONDS, sessionize
from threadloom.sinks import dataset as sinks
from threadloom.sources import export as src

ORDER = ("channel", "date", "pos")


@dataclass
class Options:
    system_prompt: str | None = None  # no system message unless configured (as in the reference code)
    window: float = 7200.0
    min_messages: int = 2
    max_messages: int = 40
    max_length: int = 2048
    min_formatted: int = 2
    counter: TokenCounter = octet_proxy
    scope: str = "global"            # "global" (the reference) or "channel"
    seed: int = 42
    test_fraction: float = 0.1
    split_mode: str = "exact"         # "exact" or "hash"
    bucket_seconds: float = DEFAULT_BUCKET_SECONDS
    newline: str = "literal"
    keep_versions: int = 1            # former versions left in the output folder
    large_bytes: int | None = 1 << 30  # export files above are read in pieces (None: never)


@dataclass
class BuildResult:
    counters: dict = field(default_factory=dict)
    card: dict = field(default_factory=dict)
    paths: dict = field(default_factory=dict)
    file_report: list = field(default_factory=list)  # per channel: n_files, n_failed, n_messages
    failed_files: int = 0


def scope_keys(scope: str) -> tuple[str, ...]:
    return {"global": (), "channel": ("channel",)}[scope]


def examples_from_messages(messages: DataFrame, users: DataFrame, opt: Options,
                           observe: dict | None = None, table: str | None = None) -> DataFrame:
    """Bronze messages -> split examples.  The exact split writes the examples
    once (to ``table``, see :func:`split.split_exact`); the rest is lazy."""
    obs = observe if observe is not None else {}
    valid = filters.valid_messages(messages)
    if "found" in obs:
        valid = valid.observe(obs["found"], F.count(F.lit(1)).alias("messages_found"),
                              F.count_if(F.col("ts_num").isNull()).alias("bad_ts"))
    # the author name (J1, F10) is computed and then discarded by the reference;
    # it does not reach the dataset, so the build does not join for it
    # (``authors.resolve_author`` provides it where wanted)
    msgs = valid.filter(F.col("ts_num").isNotNull())
    grouped = sessionize(msgs, keys=scope_keys(opt.scope), ts="ts_num", order=ORDER, thread="thread_ts",
                         window=opt.window, max_messages=opt.max_messages, min_messages=opt.min_messages,
                         bucket_seconds=opt.bucket_seconds)
    convs = conversations.clean_and_collect(grouped, users, system_prompt=opt.system_prompt)
    if "grouped" in obs:
        convs = convs.observe(obs["grouped"], F.count(F.lit(1)).alias("conversations_grouped"))
    allx = examples.to_examples(convs, opt.counter, max_length=opt.max_length, min_size=opt.min_formatted,
                                newline=opt.newline, keep_skipped=True)
    if "formatted" in obs:
        allx = allx.observe(obs["formatted"], F.count(F.lit(1)).alias("conversations_formatted"),
                            F.count_if("skipped").alias("examples_skipped"))
    ex = allx.filter(~F.col("skipped")).drop("skipped")
    if opt.split_mode == "exact":
        return split.split_exact(ex, "conv_id", seed=opt.seed, fraction=opt.test_fraction, table=table)
    out = split.split_hash(ex, "conv_id", seed=opt.seed, fraction=opt.test_fraction)
    return out.withColumn("split_hash", split.split_hash_key("conv_id", opt.seed))


CURRENT = "CURRENT"
TABLES = ("bronze", "quarantine", "dataset", "dataset_sample", "dataset_card")


def current_version(spark: SparkSession, out_dir: str) -> str | None:
    """The folder of the committed version, as the pointer file names it; None
    before the first commit."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    pointer = Path(f"{out_dir}/{CURRENT}")
    fs = pointer.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return f"{out_dir}/versions/{bytes(stream.readAllBytes()).decode().strip()}"
    finally:
        stream.close()


def table_paths(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """The committed tables: bronze, quarantine, dataset, sample, card.  Resolve
    them once and read all from the same version."""
    version = current_version(spark, out_dir)
    if version is None:
        raise FileNotFoundError(f"no committed dataset in {out_dir}")
    return {n.removeprefix("dataset_"): f"{version}/{n}" for n in TABLES}


def commit_version(spark: SparkSession, out_dir: str, version: str) -> None:
    """Make ``versions/<version>`` the committed one.  The only step a reader can
    see is the rename of a written pointer file over the former one."""
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    new = Path(f"{out_dir}/_{CURRENT}-{version}")
    fs = new.getFileSystem(conf)
    stream = fs.create(new, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    qualified = lambda p: fs.makeQualified(p)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified(new).toUri(), conf).rename(
        qualified(new), qualified(Path(f"{out_dir}/{CURRENT}")), options)


def drop_old_versions(spark: SparkSession, out_dir: str, keep: int) -> list[str]:
    """Remove all but the committed version and the ``keep`` newest others; returns
    the names of those removed.  Versions carry the time of their build in front of their name,
    so builds that are still running, being newer, are kept first."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    folder = Path(f"{out_dir}/versions")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    held = (current_version(spark, out_dir) or "").rsplit("/", 1)[-1]
    names = sorted((st.getPath().getName() for st in fs.listStatus(folder)), reverse=True) if fs.exists(folder) else []
    old = [n for n in names if n != held][keep:]
    for n in old:
        fs.delete(Path(f"{out_dir}/versions/{n}"), True)
    return old


def build_dataset(spark: SparkSession, export_dir: str, out_dir: str, options: Options | None = None) -> BuildResult:
    """The whole build.  All tables are written to a new folder below
    ``out_dir/versions``; when every guard (S8) has passed, one pointer file
    (``CURRENT``) is renamed over the former one.  A reader that resolves
    ``table_paths`` finds the former version or the new one, whole, whenever the
    build dies; an unfinished version is removed by its build or, if that is
    killed, by a later one.  Options.keep_versions former versions stay for
    readers that still use them."""
    opt = options or Options()
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    staged = f"{out_dir}/versions/{version}"
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(out_dir).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        result = _build(spark, export_dir, staged, opt)
        for scratch in ("decoded", "decoded-records", "decoded-elements", "examples"):
            fs.delete(Path(f"{staged}/{scratch}"), True)
        commit_version(spark, out_dir, version)
    except BaseException:
        fs.delete(Path(staged), True)
        raise
    drop_old_versions(spark, out_dir, opt.keep_versions)
    result.paths = {n.removeprefix("dataset_"): f"{staged}/{n}" for n in TABLES}
    return result


def _build(spark: SparkSession, export_dir: str, out_dir: str, opt: Options) -> BuildResult:
    exp = src.read_export(spark, export_dir, decoded_path=f"{out_dir}/decoded", large_bytes=opt.large_bytes)
    report = [r.asDict() for r in src.file_report(exp.files).orderBy("channel").collect()]  # one row a channel
    bronze = f"{out_dir}/bronze"
    src.write_bronze(exp.messages, bronze)
    exp.quarantine.write.mode("overwrite").parquet(f"{out_dir}/quarantine")
    messages = src.read_bronze(spark, bronze)
    if filters.valid_messages(messages).isEmpty():
        raise ValueError(f"no messages found in {export_dir}")

    obs = {"found": Observation("found"), "grouped": Observation("grouped"), "formatted": Observation("formatted")}
    ex = examples_from_messages(messages, exp.users, opt, observe=obs, table=f"{out_dir}/examples")
    data = f"{out_dir}/dataset"
    ex.select("conv_id", "text", "messages", "length", "n_tokens", "split", "split_hash") \
      .write.mode("overwrite").partitionBy("split").parquet(f"{data}/parquet")

    written = spark.read.schema(ex.select("conv_id", "text", "messages", "length", "n_tokens", "split_hash", "split").schema) \
        .parquet(f"{data}/parquet")
    card = sinks.write_card(written, f"{out_dir}/dataset_card")
    counters = {}
    for o in obs.values():
        counters.update(o.get)
    counters["train"] = card["train_samples"]
    counters["test"] = card["eval_samples"]
    if counters["train"] + counters["test"] == 0:
        raise ValueError("no valid examples found after filtering")
    written.select("split", "messages").write.mode("overwrite").partitionBy("split").json(f"{data}/jsonl")
    sinks.write_sample_log(written, f"{out_dir}/dataset_sample")
    return BuildResult(counters=counters, card=card, file_report=report,
                       failed_files=sum(r["n_failed"] for r in report))
