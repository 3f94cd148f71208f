from . import features, intervals, labels, selection, sessions

__all__ = ["features", "intervals", "labels", "selection", "sessions"]
