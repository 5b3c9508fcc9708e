"""Company-risk analytics expressed as Spark DataFrame operators."""

from riskloom.config import EngineConfig, RiskWeights

__all__ = ["EngineConfig", "RiskWeights"]
