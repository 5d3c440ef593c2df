from .increment import LateRows, apply_batch, run_increment, run_increment_load

__all__ = ["LateRows", "apply_batch", "run_increment", "run_increment_load"]
