"""Stages of a run: readers get their columns only, and nothing is left behind."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from testbed.city import city
from townform.operators.neighbours import close_pairs
from townform.plans import blocks as B
from townform.plans import chain
from townform.session import Stages, checkpoint_dir
from townform.sources import inputs as I
from townform.sources.results import read_final

SF = "/root/testdata/sf0.001"


def left(spark):
    return list(Path(checkpoint_dir(spark)).glob("stages-*"))


def test_block_edges_read_ids_only(spark):
    c = city(spark, SF)
    with Stages(spark) as stage:
        pairs = stage(close_pairs(I.prepare_buildings(c.bati, c.zones)))
        plan = B.block_edges(pairs)._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<id_zone:bigint,pk_a:bigint,pk_b:bigint,pk_usr_a:bigint,pk_usr_b:bigint,dist:double>" in plan
        assert pairs.where("cover_a is not null").count() == pairs.count() > 0 and left(spark)
    assert not left(spark)


def test_a_run_leaves_no_stage(spark, tmp_path):
    c = city(spark, SF)
    chain.run_chain(c, str(tmp_path))
    assert not left(spark) and read_final(spark, str(tmp_path), "final_block_outlines").count() > 400
    again = chain.Inputs(c.zones, c.usr, c.bati, c.roads.withColumn("largeur", F.raise_error(F.lit("no width")).cast("double")), c.iris)
    with pytest.raises(Exception, match="no width"):
        chain.run_chain(again, str(tmp_path))
    assert not left(spark) and read_final(spark, str(tmp_path), "final_building_indicators").count() == 200


def test_buildings_of_no_unit_stay_on_request(spark, tmp_path):
    chain.run_chain(city(spark, SF), str(tmp_path), require_usr=False)
    rows = read_final(spark, str(tmp_path), "final_building_indicators")
    assert rows.count() > 200 and rows.where("pk_usr is null").count() == rows.count() - 200


def test_units_and_members_are_kept(spark):
    """What the joins derive about boxes of units stays off the rows of the source; members are not found again by each reader."""
    with Stages(spark) as stage:
        r = chain.compute(city(spark, SF), stage=stage)
        for kept in (r.usr, r.members):
            plan = kept._jdf.queryExecution().optimizedPlan().toString()
            assert "Join" not in plan and "Aggregate" not in plan and "p_partkey" not in plan
        assert r.usr.count() == 10 and r.members.count() == 200
