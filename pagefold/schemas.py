"""Row shapes exchanged between stages."""

from __future__ import annotations

RAW_FILES = "path string, modificationTime timestamp, length long, content binary"
CHUNK_FIELDS = (
    "chunk_id:int,page_num:int,text:string,char_count:int,split_method:string,language:string,"
    "metadata:map<string,string>,has_structure:boolean,structure_types:array<string>,warning:string"
)
FINDING = "struct<type:string,count:int,examples:array<string>,avg_confidence:double,method:string>"
# Chunk documents as they are written and read back: one JSON object per document.
CHUNK_DOCUMENT = (
    "source_file string, file_type string, total_pages long, total_chunks long, "
    "total_characters long, average_chunk_size double, "
    f"chunks array<struct<{CHUNK_FIELDS}>>, "
    "processing_info struct<chunk_size:int,chunk_overlap:int,split_method:string,"
    "methods_used:array<string>,privacy_filtering:boolean,privacy_method:string,"
    f"privacy_findings:array<struct<page:int,findings:array<{FINDING}>>>>"
)
VECTORS = (
    "source_file string, chunk_id int, page_num int, char_count int, has_embedding boolean, "
    "embedding array<float>, embedding_dim int, model_name string, metadata map<string,string>"
)
INDEX = (
    "id string, embedding array<float>, document string, source_file string, chunk_id int, "
    "page_num int, char_count int, custom map<string,string>, source_bucket int"
)
