"""Registered queries, the inputs they stand in for, and their SQL answers."""
