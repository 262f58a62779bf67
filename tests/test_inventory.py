"""R7, R8 and the N4 tokenizer plug-in."""

import json
import os

from pyspark.sql import functions as F

from threadloom.functions.tokens import tokenizer_counter, tokenizer_ids
from threadloom.operators.inventory import artifact_inventory, model_info, read_json_doc, run_log, stage_durations


def test_artifact_inventory(spark, tmp_path):
    d = tmp_path / "model"
    (d / "final_model").mkdir(parents=True)
    (d / "pytorch_model-00001.bin").write_bytes(b"x" * 1000)
    (d / "model.safetensors").write_bytes(b"y" * 3000)
    (d / "final_model" / "pytorch_model-00002.bin").write_bytes(b"z" * 24)
    (d / "model_card.json").write_text(json.dumps({"base_model": "m", "dataset_info": {"train_samples": 9}}))
    r = artifact_inventory(spark, str(d)).first()
    total = 1000 + 3000 + 24 + os.path.getsize(d / "model_card.json")
    assert abs(r.size_gb * 1024 ** 3 - total) < 1e-3
    assert r.n_files == 4 and r.num_shards == 1  # only top-level shards count
    card = read_json_doc(spark, str(d / "model_card.json")).first()
    assert card.dataset_info.train_samples == 9


def test_model_info(spark, tmp_path):
    d = tmp_path / "model"
    (d / "_state" / ".deep").mkdir(parents=True)
    (d / "_state" / ".deep" / ".x").write_bytes(b"x" * 70)
    (d / ".hidden").write_bytes(b"x" * 30)
    r = model_info(spark, str(d)).first()
    assert (round(r.size_gb * 1024 ** 3), r.n_files, r.num_shards, r.model_card, r.training_config) == (100, 2, 0, None, None)
    (d / "model_card.json").write_text('{"base_model":\n "m"}')
    r = model_info(spark, str(d)).first()
    assert json.loads(r.model_card) == {"base_model": "m"} and r.training_config is None and r.n_files == 3


LOG = """2031-05-06 07:08:09,100 - INFO - Starting training pipeline:
2031-05-06 07:08:09,350 - INFO - first step
-- no time here --
2031-05-06 07:08:11,000 - WARNING - second step
2031-05-06 08:00:00,000 - INFO - Starting training pipeline:
2031-05-06 08:00:04,250 - ERROR - third step
"""


def test_run_log(spark, tmp_path):
    p = tmp_path / "steps.log"
    p.write_text(LOG)
    log = run_log(spark, str(p))
    rows = log.orderBy("line_no").collect()
    assert [(r.run, r.level, r.since_prev_s) for r in rows] == [
        (1, "INFO", None), (1, "INFO", 0.25), (1, "WARNING", 1.65), (2, "INFO", None), (2, "ERROR", 4.25)]
    assert {r.run: r.seconds for r in stage_durations(log).collect()} == {1: 1.9, 2: 4.25}


def test_tokenizer_plugin(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers, processors, trainers
    tok = Tokenizer(models.WordLevel(unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator(["hello world", "Human: hi"], trainers.WordLevelTrainer(special_tokens=["[UNK]", "<s>"]))
    tok.post_processor = processors.TemplateProcessing(single="<s> $A", special_tokens=[("<s>", 1)])
    path = str(tmp_path / "tok.json")
    tok.save(path)
    df = spark.createDataFrame([("hello world",), (None,), ("Human: hi there",)], "t string")
    got = [r.n for r in df.select(tokenizer_counter(path)(F.col("t")).alias("n")).collect()]
    assert got == [3, None, 5]  # BOS added by the post-processor
    ids = df.select(tokenizer_ids(path)(F.col("t")).alias("ids")).first().ids
    assert ids[0] == 1 and len(ids) == 3
