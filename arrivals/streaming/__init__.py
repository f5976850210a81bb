from arrivals.streaming.monthly import load_new_drops

__all__ = ["load_new_drops"]
