"""Schemas of the metric tables. Ids are text; sentinels exist only in files, tables have nulls."""

from __future__ import annotations

from pyspark.sql.types import StructType

_HEAD = "id string, title string, year string"
_BOXES = "array<struct<label:string,score:double,box:array<double>>>"
_PAIRS = "array<struct<label:string,iou:double,score_a:double,score_b:double,box_a:array<double>,box_b:array<double>>>"


def _metric(columns: str) -> str:
    return f"{_HEAD}, {columns}"


def _detector(boxes: str) -> str:
    return ", ".join(f"{k}_n int, {k}_top_label string, {k}_top_score double, {k}_boxes {boxes}" for k in ("creature", "weapon"))


# Names of tables and columns that files are exchanged with.
TABLES: dict[str, str] = {
    "corpus": "id string, title string, year int, poster_path string",
    "color_metrics": _metric("brightness double, dark_share double, saturation double, red_share double, palette array<string>, palette_share array<double>, band_red double, band_warm double, band_green double, band_blue double, band_purple double, band_dark double"),
    "iqa_multi_score": _metric("clipiqa double, musiq double, brisque double, error string"),
    "nima_score": _metric("nima_score double, error string"),
    "laion_aesthetic_score": _metric("aesthetic_score double, error string"),
    "embeddings": "id string, vec array<float>, revision string",
    "census": "id string, label string, score double, title string, year string, is_animal boolean, is_creature boolean",
    "fear_axis": "id string, axis double, title string, year string",
    "typography": "id string, axis double, title string, year string",
    "genre_classifier": "id string, true_genre string, pred_genre string, agree boolean, sim_horror double, sim_scifi double, sim_thriller double, sim_mystery double",
    "medium": _metric("p_painted double, painted boolean, error string"),
    "face_detect": _metric("n_faces int, face_area double, max_conf double, face_boxes string, error string"),
    "face_expression": "id string, face_idx int, box string, label string, score double",
    "geometric_composition": _metric("symmetry double, neg_space double, complexity double, mass_y double, mass_x double, text_area double, text_y double, text_regions int, align_score double, thirds_dist double, n_blocks int, balance double, harmony double, diagonal_score double, pyramid_shift double"),
    "depth_estimation": _metric("mean_depth double, p95_depth double, depth_std double, close_area_frac double, error string"),
    "saliency_prediction": _metric("peak_x double, peak_y double, top10pct_mass double, mean_saliency double, error string"),
    "pose_dynamism": _metric("n_persons int, kpt_bbox_area_frac double, limb_asymmetry double, mean_kpt_confidence double, box array<double>, keypoints array<array<double>>, error string"),
    "creature_weapon_owlv2": _metric(f"{_detector(_BOXES)}, error string"),
    "creature_weapon_dino": _metric(f"{_detector(_BOXES)}, error string"),
    "creature_weapon_agreement": _metric(f"{_detector(_PAIRS)}, creature_label_agree int, weapon_label_agree int"),
    "human_review": "id string, title string, poster_path string, human_verdict string",
    "imdb_basics": "tconst string, titleType string, genres string",
}
TABLES |= {"siglip_census": TABLES["census"], "siglip_fear_axis": TABLES["fear_axis"], "siglip_typography": TABLES["typography"]}
#: Columns in which files write -1 for "none".
SENTINELS = {"geometric_composition": ["text_y", "thirds_dist", "balance", "harmony", "align_score"]}


def schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def text_schema(table: str) -> StructType:
    """The same columns as texts, as a CSV file has them."""
    return StructType.fromDDL(", ".join(f"`{f.name}` string" for f in schema(table)))
