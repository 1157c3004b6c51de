import corpus_pipeline
from tideglass.llm import decontamination, minhash_dedup, mixing, quality_rules, substring_dedup
from tideglass.llm.common import materialize


def test_stages_take_effect_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "minhash_dedup", "substring_dedup", "decontamination", "mixing"]
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        made[name] = now = materialize(stage(spark, docs, sf_dir), name)
        if name != "mixing":
            assert now.columns == docs.columns and 0 < now.count() <= docs.count()
        docs = now
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = ids(quality_rules.judged(whole).where("kept"))
    assert ids(made["quality_rules"]) == kept
    near = minhash_dedup.near_duplicates(made["quality_rules"])
    assert ids(made["minhash_dedup"]) == ids(near.where("kept"))
    assert substring_dedup.without_repeats(made["substring_dedup"]).where("n_removed > 0").count() <= made["substring_dedup"].count() * 0.05
    found = ids(decontamination.contaminated(made["substring_dedup"], spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
    assert ids(made["decontamination"]) == ids(made["substring_dedup"]) - found
    assert ids(made["mixing"]) == ids(mixing.mix(made["decontamination"]).where("repetitions > 0"))
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r.doc_id, r.taken) for r in run.collect()) == sorted((r.doc_id, r.taken) for r in made["mixing"].collect())
