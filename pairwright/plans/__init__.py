from .gather import gather_instructions
from .judge import complete_and_judge, critique_completions
from .prefer import PREFERENCE_OUTPUTS, build_preferences, export_training_rows, write_preferences
from .publish import current_version, publish, published_path, read_published
from .shards import carry_shards
from .stages import open_session, stage_bucketed, stage_table, write_counted

__all__ = [
    "gather_instructions", "complete_and_judge", "critique_completions", "build_preferences",
    "export_training_rows", "write_preferences", "PREFERENCE_OUTPUTS", "current_version", "publish",
    "published_path", "read_published", "carry_shards", "open_session", "stage_bucketed", "stage_table",
    "write_counted",
]
