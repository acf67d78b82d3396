from .readers import (
    read_csv,
    read_jsonl,
    read_parquet,
    read_parquet_dir,
    read_shards,
    shard_paths,
    split_corrupt,
    stage_shards,
)
from .annotation_shapes import read_annotations
from .instruction_files import read_instruction_sources
from .sinks import save_bucketed, stage_path, write_jsonl, write_parquet, write_sharded

__all__ = [
    "read_csv", "read_jsonl", "read_parquet", "read_parquet_dir", "read_shards",
    "shard_paths", "split_corrupt", "stage_shards", "read_annotations", "read_instruction_sources", "save_bucketed", "stage_path",
    "write_jsonl", "write_parquet", "write_sharded",
]
