from . import prediction, training, voting

__all__ = ["prediction", "training", "voting"]
