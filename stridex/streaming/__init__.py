from .live_prediction import NewestTable, bucketed, start_prediction_stream, stream_predict_events
from .progress import BatchProgress

__all__ = ["BatchProgress", "NewestTable", "bucketed", "start_prediction_stream", "stream_predict_events"]
