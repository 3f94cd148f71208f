from .readers import (read_training, read_live, read_events, events_as_training, events_as_live, stream_live,
                      stream_events_as_live, valid_axes, validate_samples)
from .sinks import append_predictions, write_batch, read_predictions
from .commits import CommitLog
from .layout import bucketed, read_clustered, write_clustered
from .models import PublishedModel, load_forest, load_tree, publish_model, save_model

__all__ = ["read_training", "read_live", "read_events", "events_as_training", "events_as_live", "stream_live",
           "stream_events_as_live", "valid_axes", "validate_samples", "append_predictions", "write_batch",
           "read_predictions", "CommitLog", "bucketed", "read_clustered", "write_clustered", "PublishedModel", "publish_model", "save_model", "load_tree", "load_forest"]
