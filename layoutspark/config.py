"""Thresholds, as frozen settings that fold into plans as literals, with the reference's defaults (fixed values)."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class OCR:
    min_confidence: float = 0.45
    enable_second_pass: bool = True
    second_pass_min_avg_conf: float = 0.62
    second_pass_min_lines: int = 8
    second_pass_merge_iou: float = 0.8


@dataclass(frozen=True)
class Grouping:
    max_vertical_gap_ratio: float = 1.6
    max_block_vertical_gap_ratio: float = 2.1
    max_line_height_ratio: float = 1.9
    min_horizontal_overlap_ratio: float = 0.08
    max_alignment_delta_ratio: float = 1.8
    max_reading_flow_dx_ratio: float = 7.0
    absorb_short_text_max_chars: int = 18
    absorb_max_center_distance_ratio: float = 3.0
    line_column_align_ratio: float = 1.4
    block_row_band_ratio: float = 0.9


@dataclass(frozen=True)
class Classification:
    headline_height_ratio: float = 1.38
    headline_max_lines: int = 3
    headline_max_chars: int = 140
    content_min_lines: int = 3
    content_height_upper_ratio: float = 1.25
    content_min_chars: int = 60
    pair_max_vertical_ratio: float = 0.35
    headline_max_digit_ratio: float = 0.45
    headline_min_alpha_chars: int = 5
    headline_content_min_overlap: float = 0.15
    prefix_split_min_total_lines: int = 4
    prefix_headline_height_ratio: float = 1.16
    prefix_headline_gap_ratio: float = 1.6
    prefix_headline_gap_height_ratio: float = 0.8
    prefix_headline_width_ratio_max: float = 0.9
    prefix_title_pattern_max_chars: int = 80
    prefix_title_pattern_min_rest_chars: int = 80


@dataclass(frozen=True)
class Mask:
    text_dilation_ratio: float = 0.005
    non_text_open_ratio: float = 0.003
    non_text_close_ratio: float = 0.006
    white_threshold: int = 242
    low_saturation_threshold: int = 20
    visual_texture_std_threshold: float = 12.0


@dataclass(frozen=True)
class Visual:
    simple_mode: bool = False
    merge_iou_threshold: float = 0.25
    split_trigger_area_ratio: float = 0.75
    split_min_component_area_ratio: float = 0.0035
    split_texture_std_threshold: float = 16.0
    split_saturation_threshold: int = 32
    split_seed_open_ratio: float = 0.002
    split_seed_close_ratio: float = 0.004
    grid_split_rows: int = 3
    grid_split_cols: int = 2
    grid_split_expand_ratio: float = 0.02
    grid_min_non_text_ratio: float = 0.22
    grid_min_visual_score: float = 0.42
    grid_component_min_cell_area_ratio: float = 0.02
    grid_strip_span_ratio: float = 0.9
    grid_strip_other_ratio: float = 0.4
    fullpage_rescue_min_edge_density: float = 0.03
    fullpage_rescue_min_entropy: float = 4.3
    fullpage_rescue_max_white_ratio: float = 0.22
    fullpage_rescue_max_text_ratio: float = 0.16
    strip_projection_min_fill_ratio: float = 0.06
    strip_projection_min_run_ratio: float = 0.08
    strip_projection_pad_ratio: float = 0.01
    fallback_texture_std_threshold: float = 18.0
    fallback_saturation_threshold: int = 36
    fallback_edge_open_ratio: float = 0.0018
    fallback_edge_close_ratio: float = 0.0035
    fallback_min_component_area_ratio: float = 0.0024
    large_box_split_open_ratio: float = 0.0015
    large_box_split_close_ratio: float = 0.003
    large_box_split_min_component_area_ratio: float = 0.015
    panel_merge_gap_ratio: float = 0.02
    panel_merge_min_cross_overlap: float = 0.08
    panel_merge_max_union_area_ratio: float = 0.72
    panel_drop_small_inside_ratio: float = 0.8
    panel_text_heavy_drop_ratio: float = 0.48
    panel_text_heavy_max_edge_density: float = 0.018
    panel_min_area_ratio: float = 0.009
    small_textlike_max_area_ratio: float = 0.08
    small_textlike_max_entropy: float = 4.5
    small_textlike_max_edge_density: float = 0.03
    half_rescue_min_side_area_ratio: float = 0.08
    half_rescue_component_area_ratio: float = 0.008
    half_rescue_texture_std_threshold: float = 11.0
    half_rescue_saturation_threshold: int = 28
    min_visual_area_ratio: float = 0.0125
    min_visual_short_side_ratio: float = 0.05
    min_visual_width_px: int = 48
    min_visual_height_px: int = 48
    max_aspect_ratio: float = 12.0
    min_edge_density: float = 0.006
    min_fill_ratio: float = 0.09
    max_visual_area_ratio: float = 0.65
    edge_touch_reject_area_ratio: float = 0.42
    edge_touch_rescue_min_edge_density: float = 0.01
    edge_touch_rescue_min_entropy: float = 3.3
    edge_touch_rescue_max_area_ratio: float = 0.35
    max_text_overlap_ratio: float = 0.22
    text_heavy_rescue_min_area_ratio: float = 0.012
    text_heavy_rescue_min_edge_density: float = 0.012
    text_heavy_rescue_min_entropy: float = 3.4
    small_region_high_quality_area_ratio: float = 0.015
    small_region_min_edge_density: float = 0.01
    small_region_min_entropy: float = 3.0
    min_entropy: float = 2.0
    strip_span_ratio: float = 0.9
    strip_other_ratio: float = 0.38
    fragment_merge_gap_ratio: float = 0.018
    fragment_merge_min_cross_overlap: float = 0.15
    fragment_merge_max_union_area_ratio: float = 0.42
    parent_child_iou_merge: float = 0.62
    max_visuals_full_photo_page: int = 3
    max_visuals_collage_card_page: int = 6
    max_visuals_comic_panel_page: int = 8
    max_visuals_text_heavy_editorial_page: int = 3
    simple_mode_max_visuals: int = 4


@dataclass(frozen=True)
class Crop:
    crop_padding_ratio: float = 0.01
    crop_padding_px: int = 6


@dataclass(frozen=True)
class Correction:
    enabled: bool = True
    min_word_len: int = 4
    similarity_threshold: float = 0.93
    min_margin_over_second: float = 0.06
    max_changes_per_block: int = 4
    lexicon_path: str = ""


@dataclass(frozen=True)
class Settings:
    ocr: OCR = field(default_factory=OCR)
    grouping: Grouping = field(default_factory=Grouping)
    classification: Classification = field(default_factory=Classification)
    mask: Mask = field(default_factory=Mask)
    visual: Visual = field(default_factory=Visual)
    crop: Crop = field(default_factory=Crop)
    text_correction: Correction = field(default_factory=Correction)


def load_settings(path: str | None = None) -> Settings:
    """Defaults with what a JSON file has by section; keys that no section knows are passed over, a missing file is an error."""
    base = Settings()
    if path is None:
        return base
    given = json.loads(Path(path).read_text(encoding="utf-8"))
    changed = {}
    for section in fields(base):
        own = getattr(base, section.name)
        known = {f.name for f in fields(own)}
        changed[section.name] = replace(own, **{k: v for k, v in (given.get(section.name) or {}).items() if k in known})
    return Settings(**changed)
