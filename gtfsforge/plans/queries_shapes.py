"""Registered queries: shapes (O-G4 / O-B17)."""

from __future__ import annotations

from gtfsforge.functions import geo
from gtfsforge.plans import gtfs_kv1 as kv1
from gtfsforge.plans.registry import PAT_SQL, kv1_tables, register, sql_key
from gtfsforge.plans.views import World, oracle


def _tables(w: World):
    t = kv1_tables(w)
    t["pool"] = w.kv_pool
    t["point_all"] = w.kv_point_all
    return t


def _shape_sql(fn: str, match_transport: bool, exclude_train: bool) -> str:
    cond = "AND pool.transporttype = line.transporttype" if match_transport else ""
    excl = ("AND jt.dataownercode || '|' || jt.lineplanningnumber NOT IN (SELECT dataownercode || '|' || "
            "lineplanningnumber FROM kv_line WHERE transporttype = 'TRAIN')") if exclude_train else ""
    return oracle(["kv_jopatili", "kv_pool", "kv_point_all", "kv_line"], f"""
, s AS (
  SELECT {sql_key('jt.version', 'jt.dataownercode', 'jt.lineplanningnumber', 'jt.journeypatterncode')} AS shape_id,
         pt.locationx_ew, pt.locationy_ns,
         {fn}() OVER (PARTITION BY jt.version, jt.dataownercode, jt.lineplanningnumber, jt.journeypatterncode
                      ORDER BY jt.timinglinkorder, pool.distancesincestartoflink) AS shape_pt_sequence
  FROM kv_jopatili jt
  JOIN kv_pool pool ON jt.dataownercode = pool.dataownercode AND jt.userstopcodebegin = pool.userstopcodebegin
   AND jt.userstopcodeend = pool.userstopcodeend AND jt.version = pool.version
  JOIN kv_line line ON jt.dataownercode = line.dataownercode AND jt.lineplanningnumber = line.lineplanningnumber
   AND jt.version = line.version
  JOIN kv_point_all pt ON pool.pointdataownercode = pt.dataownercode AND pool.pointcode = pt.pointcode
   AND pool.version = pt.version
  WHERE 1 = 1 {cond} {excl})
SELECT DISTINCT shape_id, CAST(lat AS DECIMAL(8,5)) AS shape_pt_lat, CAST(lon AS DECIMAL(7,5)) AS shape_pt_lon,
       CAST(shape_pt_sequence AS INTEGER) AS shape_pt_sequence
FROM {geo.oracle_sql_rd_to_wgs84('s', 'locationx_ew', 'locationy_ns')} g""")


@register("gtfs_shapes_rownum_g4", _shape_sql("row_number", True, False))
def q_shapes_rownum(spark, sf):
    return kv1.shapes(_tables(World(spark, sf)), ties="row_number", match_transport=True)


@register("gtfs_shapes_rank_g4", _shape_sql("rank", False, True))
def q_shapes_rank(spark, sf):
    return kv1.shapes(_tables(World(spark, sf)), ties="rank", match_transport=False, exclude_train=True)
