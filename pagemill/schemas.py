"""Schemas of the tables that are read and written, with the names of the JSON keys."""

PAGE_BLOCKS = (
    "source string, page int, ord int, type string, content_text string, "
    "content_table struct<rows:array<array<string>>,row_count:int,col_count:int>, confidence double, bbox array<double>, block_id string, "
    "metadata struct<font_info:struct<fonts:array<string>,avg_size:double,max_size:double>,line_count:int,table_index:int,xref:int,"
    "image_index:int,width:int,height:int,is_ocr:boolean,low_confidence_reason:string>"
)
CHUNKS = (
    "chunk_id string, content string, source string, page_start int, page_end int, token_count int, char_count int, rule_score double, "
    "llm_quality string, llm_confidence double, llm_reason string, metadata map<string,string>, created_at string"
)
