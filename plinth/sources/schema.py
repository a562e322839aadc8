"""The knowledge store's tables: columns, keys, references, domains and checks, declared once (fixed names).

Types: s text, i integer, d double. A name that ends in ``!`` must not be null. References are ``column>table.key``.
Checks are SQL conditions; a row for which one is false violates it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "i": T.LongType(), "d": T.DoubleType()}
STATES = "resolution_state in ('exact','resolved_deterministically','ambiguous','unresolved')"
TOP_LEFT = "coordinate_space = 'pdf_points_top_left'"
BOX, BOX_COLUMNS = "x_min <= x_max and y_min <= y_max", "x_min:d y_min:d x_max:d y_max:d"
SURE = "confidence between 0 and 1"


@dataclass(frozen=True)
class Table:
    columns: str
    key: tuple[str, ...] = ("id",)
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[str, ...] = ()
    checks: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.split(":")[0] for c in self.columns.split()]

    @property
    def required(self) -> list[str]:
        return [c.split(":")[0] for c in self.columns.split() if c.endswith("!")]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(n, _TYPES[k.rstrip("!")]) for n, k in (c.split(":") for c in self.columns.split())])


_SOURCE = "source_model_id:s source_unique_id:s"
_TRUST = "provenance:s! confidence:d"
_BY_SOURCE = (("source_model_id", "source_unique_id"),)
_MODEL = "source_model_id>source_models.id"

TABLES: dict[str, Table] = {
    "documents": Table("id:s! identity:s! title:s! source_filename:s! source_sha256:s!", unique=(("identity",),), checks=("source_sha256 rlike '^[0-9a-f]{64}$'",)),
    "pdf_pages": Table("id:s! document_id:s! page_number:i! width_points:d! height_points:d! rotation:i! media_x_min:d media_y_min:d media_x_max:d media_y_max:d crop_x_min:d crop_y_min:d crop_x_max:d crop_y_max:d coordinate_space:s provenance:s!", unique=(("document_id", "page_number"),), references=("document_id>documents.id",), checks=("page_number >= 1", "width_points > 0", "height_points > 0", "rotation in (0,90,180,270)", TOP_LEFT)),
    "pdf_text_blocks": Table(f"id:s! page_id:s! order_index:i! text:s! {BOX_COLUMNS} coordinate_space:s! provenance:s! evidence_id:s!", unique=(("page_id", "order_index"),), references=("page_id>pdf_pages.id", "evidence_id>evidence.id"), checks=("order_index >= 0", BOX, TOP_LEFT)),
    "pdf_text_lines": Table(f"id:s! block_id:s! order_index:i! text:s! {BOX_COLUMNS} coordinate_space:s! provenance:s!", unique=(("block_id", "order_index"),), references=("block_id>pdf_text_blocks.id",), checks=("order_index >= 0", BOX, TOP_LEFT)),
    "pdf_text_spans": Table(f"id:s! line_id:s! order_index:i! text:s! {BOX_COLUMNS} coordinate_space:s! provenance:s! font_name:s font_size:d font_flags:i", unique=(("line_id", "order_index"),), references=("line_id>pdf_text_lines.id",), checks=("order_index >= 0", BOX, TOP_LEFT)),
    "pdf_tables": Table(f"id:s! page_id:s! order_index:i! row_count:i! column_count:i! {BOX_COLUMNS} coordinate_space:s! provenance:s! detection_method:s! algorithm_version:s! library:s! library_version:s!", unique=(("page_id", "order_index"),), references=("page_id>pdf_pages.id",), checks=("order_index >= 0", "row_count >= 2", "column_count >= 2", "x_min < x_max and y_min < y_max", "provenance = 'derived_pdf_table'", TOP_LEFT)),
    "pdf_table_cells": Table(f"id:s! table_id:s! row_index:i! column_index:i! row_span:i! column_span:i! text:s! {BOX_COLUMNS} coordinate_space:s! provenance:s!", unique=(("table_id", "row_index", "column_index"),), references=("table_id>pdf_tables.id",), checks=("row_index >= 0", "column_index >= 0", "row_span = 1", "column_span = 1", "x_min < x_max and y_min < y_max", "provenance = 'derived_pdf_table'", TOP_LEFT)),
    "pdf_table_cell_spans": Table("cell_id:s! span_id:s! order_index:i!", key=("cell_id", "order_index"), unique=(("cell_id", "span_id"),), references=("cell_id>pdf_table_cells.id", "span_id>pdf_text_spans.id"), checks=("order_index >= 0",)),
    "source_models": Table("id:s! role:s! title:s! revit_version:s model_identity_kind:s! model_identity:s! snapshot_version_guid:s snapshot_save_number:i", unique=(("model_identity_kind", "model_identity"),), checks=("role in ('host','link')",)),
    "link_instances": Table("id:s! host_source_model_id:s! linked_source_model_id:s! source_unique_id:s! name:s transform_to_host_json:s! provenance:s!", unique=(("host_source_model_id", "source_unique_id"),), references=("host_source_model_id>source_models.id", "linked_source_model_id>source_models.id"), checks=("length(source_unique_id) > 0",)),
    "sheets": Table(f"id:s! document_id:s! number:s! name:s! pdf_page:i! export_order:i! {_SOURCE}", unique=(("document_id", "number"), ("export_order",), *_BY_SOURCE), references=("document_id>documents.id", _MODEL), checks=("pdf_page >= 1", "export_order >= 1")),
    "views": Table(f"id:s! document_id:s! name:s! view_type:s export_order:i {_SOURCE}", unique=_BY_SOURCE, references=("document_id>documents.id", _MODEL), checks=("export_order >= 1",)),
    "viewports": Table("id:s! sheet_id:s! view_id:s! placement_kind:s! sheet_x_min:d sheet_y_min:d sheet_x_max:d sheet_y_max:d sheet_coordinate_unit:s pdf_x_min:d pdf_y_min:d pdf_x_max:d pdf_y_max:d pdf_coordinate_space:s sheet_to_pdf_transform_json:s mapping_quality:s", references=("sheet_id>sheets.id", "view_id>views.id"), checks=("placement_kind in ('viewport','schedule')", "mapping_quality in ('unknown','approximate','calibrated','exact')", "sheet_x_min <= sheet_x_max and sheet_y_min <= sheet_y_max", "pdf_x_min <= pdf_x_max and pdf_y_min <= pdf_y_max")),
    "levels": Table(f"id:s! name:s! elevation:d unit:s {_SOURCE} {_TRUST}", unique=_BY_SOURCE, references=(_MODEL,), checks=(SURE,)),
    "spaces": Table(f"id:s! kind:s! name:s! number:s level_id:s {_SOURCE} phase_source_unique_id:s {_TRUST}", unique=_BY_SOURCE, references=("level_id>levels.id", _MODEL), checks=("kind in ('Room','Space','Zone','Corridor')", SURE)),
    "element_types": Table(f"id:s! family_name:s type_name:s! category:s! {_SOURCE} {_TRUST}", unique=_BY_SOURCE, references=(_MODEL,), checks=(SURE,)),
    "elements": Table(f"id:s! name:s! category:s! type_id:s space_id:s level_id:s {_SOURCE} {_TRUST}", unique=_BY_SOURCE, references=("type_id>element_types.id", "space_id>spaces.id", "level_id>levels.id", _MODEL), checks=(SURE,)),
    "evidence": Table(f"id:s! document_id:s! sheet_id:s view_id:s pdf_page:i! {BOX_COLUMNS} coordinate_space:s", references=("document_id>documents.id", "sheet_id>sheets.id", "view_id>views.id"), checks=("pdf_page >= 1", BOX, TOP_LEFT)),
    "drawing_references": Table("id:s! source_evidence_id:s! relation_type:s! printed_reference:s target_view_id:s target_sheet_id:s target_evidence_id:s resolution_state:s! provenance:s!", references=("source_evidence_id>evidence.id", "target_view_id>views.id", "target_sheet_id>sheets.id", "target_evidence_id>evidence.id"), checks=("length(trim(relation_type)) > 0", STATES, "(resolution_state in ('exact','resolved_deterministically')) = (coalesce(target_view_id, target_sheet_id, target_evidence_id) is not null)")),
    "parameters": Table(f"id:s! entity_kind:s! entity_id:s! scope:s definition_name:s! definition_key:s storage_type:s data_type_id:s parameter_type_id:s shared_parameter_guid:s unit_type_id:s raw_value_text:s raw_numeric_value:d numeric_value:d unit:s value_text:s {_TRUST} evidence_id:s", references=("evidence_id>evidence.id",), checks=("scope in ('instance','type')", SURE, "value_text is not null or raw_value_text is not null or numeric_value is not null or raw_numeric_value is not null", "numeric_value is null or unit is not null")),
    "relationships": Table(f"id:s! source_kind:s! source_id:s! relation_type:s! target_kind:s! target_id:s! phase_source_unique_id:s {_TRUST} evidence_id:s", references=("evidence_id>evidence.id",), checks=(SURE,)),
    "semantic_entities": Table("id:s! entity_class:s! label:s number:s instance_or_type:s! resolution_state:s! provenance:s! evidence_id:s", references=("evidence_id>evidence.id",), checks=("length(entity_class) > 0", "instance_or_type in ('instance','type','unknown')", STATES)),
    "semantic_bindings": Table("id:s! semantic_entity_id:s! source_kind:s! source_id:s resolution_state:s! provenance:s! evidence_id:s", references=("semantic_entity_id>semantic_entities.id", "evidence_id>evidence.id"), checks=("length(source_kind) > 0", STATES, "source_id is not null or resolution_state in ('ambiguous','unresolved')")),
    "semantic_properties": Table("id:s! semantic_entity_id:s! source_name:s! source_value:s! value_type:s raw_numeric_value:d numeric_value:d unit:s scope:s! canonical_name:s provenance:s! source_binding_id:s evidence_id:s", references=("semantic_entity_id>semantic_entities.id", "source_binding_id>semantic_bindings.id", "evidence_id>evidence.id"), checks=("scope in ('instance','type','sheet','schedule','project','unknown')", "source_binding_id is not null or evidence_id is not null", "numeric_value is null or unit is not null")),
    "semantic_relationships": Table("id:s! subject_semantic_entity_id:s! relation_type:s! object_semantic_entity_id:s! provenance:s! evidence_id:s source_binding_id:s", references=("subject_semantic_entity_id>semantic_entities.id", "object_semantic_entity_id>semantic_entities.id", "evidence_id>evidence.id", "source_binding_id>semantic_bindings.id"), checks=("length(trim(relation_type)) > 0",)),
    "annotations": Table(f"id:s! kind:s! semantic_type:s display_text:s! numeric_value:d unit:s related_entity_kind:s related_entity_id:s {_SOURCE} view_id:s {_TRUST} evidence_id:s", unique=_BY_SOURCE, references=(_MODEL, "view_id>views.id", "evidence_id>evidence.id"), checks=("kind in ('dimension','spot_elevation','spot_coordinate','text_annotation','tag','grid_reference')", SURE, "numeric_value is null or unit is not null")),
    "annotation_segments": Table("id:s! annotation_id:s! segment_index:i! numeric_value:d unit:s display_text:s value_override:s prefix:s suffix:s above:s below:s origin_json:s text_position_json:s", unique=(("annotation_id", "segment_index"),), references=("annotation_id>annotations.id",), checks=("segment_index >= 0", "numeric_value is null or unit is not null")),
    "annotation_references": Table("id:s! annotation_id:s! reference_index:i! target_source_model_id:s target_source_unique_id:s target_link_instance_id:s stable_reference:s reference_type:s is_linked:i! resolution_state:s!", unique=(("annotation_id", "reference_index"),), references=("annotation_id>annotations.id", "target_source_model_id>source_models.id", "target_link_instance_id>link_instances.id"), checks=("reference_index >= 0", "is_linked in (0,1)", "resolution_state in ('resolved','unresolved','orphan')")),
    "entity_appearances": Table(f"id:s! entity_kind:s! entity_id:s! sheet_id:s view_id:s viewport_id:s link_instance_id:s pdf_page:i! {BOX_COLUMNS} coordinate_space:s! appearance_kind:s! bbox_quality:s! provenance:s!", references=("sheet_id>sheets.id", "view_id>views.id", "viewport_id>viewports.id", "link_instance_id>link_instances.id"), checks=("pdf_page >= 1", TOP_LEFT, BOX, "appearance_kind in ('model','annotation','schedule','detail')", "bbox_quality in ('page_only','may_be_visible','view_bbox','projected_bbox','exact')", "(x_min is null) = (y_min is null) and (x_min is null) = (x_max is null) and (x_min is null) = (y_max is null)")),
    "spatial_boundaries": Table("id:s! space_id:s! link_instance_id:s loop_index:i! loop_kind:s! coordinate_system:s! unit:s! provenance:s!", unique=(("space_id", "link_instance_id", "loop_index"),), references=("space_id>spaces.id", "link_instance_id>link_instances.id"), checks=("loop_index >= 0", "loop_kind in ('outer','inner')", "coordinate_system = 'host_revit_internal_origin'", "unit = 'mm'")),
    "spatial_boundary_segments": Table("id:s! boundary_id:s! link_instance_id:s segment_index:i! start_x:d! start_y:d! start_z:d! end_x:d! end_y:d! end_z:d! source_model_id:s source_unique_id:s source_link_instance_id:s curve_kind:s", unique=(("boundary_id", "segment_index"),), references=("boundary_id>spatial_boundaries.id", "link_instance_id>link_instances.id", _MODEL, "source_link_instance_id>link_instances.id"), checks=("segment_index >= 0", "curve_kind in ('line','arc','ellipse','spline','other')")),
    "geometries": Table(f"id:s! entity_kind:s! entity_id:s! link_instance_id:s geometry_type:s! geometry_json:s! coordinate_system:s! unit:s! min_x:d! max_x:d! min_y:d! max_y:d! min_z:d! max_z:d! {_TRUST} evidence_id:s", references=("link_instance_id>link_instances.id", "evidence_id>evidence.id"), checks=("geometry_type in ('point','oriented_point','bbox2d','bbox3d','line','polyline','footprint')", "coordinate_system = 'host_revit_internal_origin'", "unit = 'mm'", "min_x <= max_x and min_y <= max_y and min_z <= max_z", SURE)),
    "search_content": Table("record_kind:s! record_id:s! content:s!", key=("record_kind", "record_id")),
}

CAPABILITIES = {
    "semantic_projection": ("semantic_entities", "semantic_bindings"), "semantic_properties": ("semantic_properties",), "semantic_relationships": ("semantic_relationships",), "drawing_references": ("drawing_references",), "pdf_tables": ("pdf_tables", "pdf_table_cells", "pdf_table_cell_spans"),
}
