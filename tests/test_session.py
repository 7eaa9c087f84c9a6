"""Scratch tables: kept while a result may read them, deleted by scope."""

from skein import session as S


def test_a_scope_deletes_what_was_made_inside(spark):
    before = S.scratch_path(spark, "t-before")
    spark.range(3).write.parquet(before)
    inner = []
    with S.scratch_scope(spark):
        for name in ("a", "b"):
            inner.append(S.scratch_path(spark, f"t-{name}"))
            spark.range(3).write.parquet(inner[-1])
        with S.scratch_scope(spark):
            inner.append(S.scratch_path(spark, "t-never-written"))
        assert S.path_exists(spark, inner[0])
    assert not any(S.path_exists(spark, p) for p in inner) and S.path_exists(spark, before)
    try:
        with S.scratch_scope(spark):
            inner.append(S.scratch_path(spark, "t-failed"))
            spark.range(3).write.parquet(inner[-1])
            raise KeyError
    except KeyError:
        pass
    assert not S.path_exists(spark, inner[-1]) and S.path_exists(spark, before)


def test_clear_scratch_deletes_only_own_paths(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(S, "_MADE", [])
    mine = S.scratch_path(spark, "t-mine")
    spark.range(3).write.parquet(mine)
    other = f"{S.checkpoint_root(spark)}/t-of-another-process"
    spark.range(3).write.mode("overwrite").parquet(other)
    assert S.clear_scratch(spark) == 1 and S.clear_scratch(spark) == 0
    assert not S.path_exists(spark, mine) and S.path_exists(spark, other)
    S.delete_path(spark, other)
    S.delete_path(spark, other)
