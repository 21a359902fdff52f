"""The complete run: sources to indicators to typologies, all communes in one job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townform.operators.neighbours import close_pairs
from townform.operators.outlines import block_outlines
from townform.params import Params
from townform.plans import blocks as B
from townform.plans.buildings import building_indicators
from townform.plans.forest import classify_from_nodes
from townform.plans.typology import classify_buildings, typo_buildings, typo_usr, typology_features
from townform.plans.usr import usr_indicators
from townform.sources import inputs as I
from townform.session import Stages, cut_lineage
from townform.sources.results import write_tables


@dataclass(frozen=True)
class Inputs:
    """Source tables."""

    zones: DataFrame
    usr: DataFrame
    bati: DataFrame
    roads: DataFrame
    iris: DataFrame


@dataclass(frozen=True)
class Results:
    communes: DataFrame
    skipped: DataFrame
    usr: DataFrame
    buildings: DataFrame
    iris: DataFrame
    pairs: DataFrame
    members: DataFrame
    building_indicators: DataFrame
    block_indicators: DataFrame
    usr_indicators: DataFrame


def compute(inputs: Inputs, codes: I.Codes = None, p: Params = Params(),
            keep: Callable[[DataFrame], DataFrame] = cut_lineage, require_usr: bool = True,
            stage: Callable[[DataFrame], DataFrame] | None = None) -> Results:
    """Indicators of all communes in ``codes`` that have buildings.

    ``keep`` is applied to the prepared buildings, which stay dealt by the key of their joins, and ``stage``
    (if given, otherwise ``keep``) to the other tables read more than once: units, close pairs, members of blocks,
    building and block indicators, of which each reader needs a few columns. All go to the shared folder, so neither a lost
    executor nor a long plan makes them be computed twice. Results of ``Stages`` are gone once it is left.
    Without ``require_usr`` buildings of no unit stay.
    """
    stage = stage or keep
    # partitioned once by the key of all later joins
    buildings = keep(I.prepare_buildings(inputs.bati, inputs.zones, codes, p, require_usr).repartition("id_zone", "pk"))
    catalogue = I.in_codes(I.scan_communes(inputs.zones), "code_insee", codes)
    ready = I.processable_communes(catalogue, buildings)
    # kept, or the tests of the boxes that the joins derive would reach the source and run on every row of it
    usr = stage(I.prepare_usr(inputs.usr, codes).join(ready.select("id_zone"), "id_zone", "left_semi"))
    roads = I.prepare_roads(inputs.roads, inputs.zones, codes)
    # of several entries of a commune one with buildings gives the outline
    outline = I.commune_outline(inputs.zones.join(ready.select(F.col("id_zone").alias("ogc_fid")), "ogc_fid", "left_semi"), codes)
    iris = I.prepare_iris(inputs.iris, codes)
    pairs = stage(close_pairs(buildings, p))
    members = stage(B.block_members(buildings, pairs, p))
    by_building = stage(building_indicators(buildings, roads, pairs, members, p))
    by_block = stage(B.block_indicators(by_building, buildings, members, pairs, p))
    by_usr = usr_indicators(usr, by_building, by_block, outline, iris, p)
    return Results(outline, I.skipped_communes(catalogue, buildings), usr, buildings, iris, pairs,
                   members, by_building, by_block, by_usr)


def run_chain(inputs: Inputs, path: str, model: PipelineModel | DataFrame | None = None, codes: I.Codes = None,
              p: Params = Params(), mode: str = "replace", require_usr: bool = True) -> None:
    """Compute everything and write the final tables below ``path``, all of them or none.

    Typologies are written when a trained model is given: a fitted pipeline, or a forest as a table of nodes.
    Stages of the run are removed at its end.
    """
    with Stages(inputs.usr.sparkSession) as stage:
        write_tables(final_tables(compute(inputs, codes, p, require_usr=require_usr, stage=stage), model, p, stage), path, mode, p)


def final_tables(r: Results, model: PipelineModel | DataFrame | None = None, p: Params = Params(),
                 stage: Callable[[DataFrame], DataFrame] = cut_lineage) -> dict[str, DataFrame]:
    """The final tables of computed results by name, typologies among them if there is a model."""
    tables = {"final_building_indicators": r.building_indicators,
              "final_block_indicators": r.block_indicators,
              "final_block_outlines": block_outlines(r.buildings, r.members, r.pairs, p),
              "final_usr_indicators": r.usr_indicators,
              "final_communes": r.communes, "final_iris": r.iris}
    if model is not None:
        features = typology_features(r.building_indicators, r.block_indicators, r.usr_indicators)
        if isinstance(model, DataFrame):
            typed = classify_from_nodes(stage(features), model)
        else:
            typed = classify_buildings(model, features)
        # both tables read it: the forest runs once
        typed = stage(typed.select("id_zone", "pk_usr", "pk_building", "i_floor", "u_floor", "typo"))
        tables["final_building_typo"] = typo_buildings(r.buildings, typed)
        tables["final_usr_typo"] = typo_usr(r.usr, typed)
    return tables
