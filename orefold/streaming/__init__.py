from orefold.streaming.change_feed import change_feed

__all__ = ["change_feed"]
