"""Row shapes that pass between the phases, and their closed vocabularies."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<text:string,font:string,size:double>"
LINE = f"struct<spans:array<{SPAN}>>"
LAYOUT_BLOCK = f"struct<type:int,bbox:array<double>,lines:array<{LINE}>>"
PAGE_LAYOUT = f"doc_id string, page int, width double, height double, blocks array<{LAYOUT_BLOCK}>, tables array<struct<bbox:array<double>>>, images array<struct<bbox:array<double>>>"
TOC = "doc_id string, pos int, level int, title string, page int"
CHAPTERS = "doc_id string, pos int, title string, start_page int, end_page int, level int"
SLICE = "struct<title:string,start_page:int,end_page:int,split_mode:string,overlap_pages:array<int>,boundary_reason:string,exception_type:string,manual_review_required:boolean,toc_level:int>"
BLOCK = "struct<type:string,text:string,source_page:int,bbox:array<double>,reading_order:int,is_overlap:boolean,dedupe_key:string,heading_level:int>"
TABLE = "struct<table_id:string,headers:array<string>,rows:array<array<string>>,markdown:string,fallback_html:string,fallback_image:string,bbox:array<double>,parent_table_id:string,table_role:string,section_title:string,child_table_ids:array<string>>"
IMAGE = "struct<asset_path:string,caption:string,bbox:array<double>,width:int,height:int>"
PAGE = f"struct<slice_page:int,source_page:int,is_overlap:boolean,markdown:string,blocks:array<{BLOCK}>,tables:array<{TABLE}>,images:array<{IMAGE}>>"
CONTENT = f"slice_file string, display_title string, start_page int, end_page int, source_pages array<{PAGE}>, warnings array<string>, manual_review_required boolean"
SNAPSHOT = "struct<bbox:array<double>,headers:array<string>,rows:array<array<string>>,markdown:string,cross_page:boolean,cross_page_count:int>"
SLICE_MANIFEST = "source_file string, total_pages int, created_at string, generator_version string, fallback_level int, slices array<struct<slice_file:string,start_page:int,end_page:int,actual_pages:int,display_title:string,toc_level:int,split_mode:string,overlap_pages:array<int>,boundary_reason:string,exception_type:string,manual_review_required:boolean>>"
EXTRACT_MANIFEST = "source_manifest string, source_file string, created_at string, generator_version string, scope string, total_slices int, success_count int, failed_count int, total_warnings int, total_elapsed_ms long, slices array<struct<slice_file:string,content_file:string,md_file:string,status:string,warning_count:int,manual_review_required:boolean,elapsed_ms:long,error_code:string,error_message:string,stage_timings:map<string,long>>>"
FORMAT_MANIFEST = "source_file string, source_extract_manifest string, generator_version string, total_slices int, slices array<struct<slice_file:string,display_title:string,order_index:int,start_page:int,end_page:int,final_md_file:string,review_report_file:string,status:string,manual_review_required:boolean>>"
SEGMENT = "ordinal int, segment_type string, text string, line_start int, line_end int, raw string"

BLOCK_TYPES = ("heading", "code", "list_item", "quote", "header", "footer", "paragraph", "footnote")
SPLIT_MODES = ("chapter", "merge", "section", "physical")
BOUNDARY_REASONS = ("chapter_boundary", "section_boundary", "page_limit", "semantic_integrity", "fallback_physical")
OVERSIZED = ("oversized_section", "oversized_semantic_block")
TABLE_ROLES = ("standalone", "parent", "child")
SEVERITIES = ("info", "warning", "error")
SEGMENT_TYPES = ("heading", "paragraph", "list", "table", "code", "image", "html_block")
MATCH_STRATEGIES = ("dedupe_key", "source_page_text_hash", "asset_ref", "none")


def known(value: Column, vocabulary: tuple[str, ...]) -> Column:
    """Whether a value is of a closed vocabulary; null is."""
    return value.isNull() | value.isin(*vocabulary)
