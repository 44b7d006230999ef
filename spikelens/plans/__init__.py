from spikelens.plans.process import Outcome, process, score_log

__all__ = ["Outcome", "process", "score_log"]
