from .scoring import requests_by_client, score_files, score_stream, size_histogram

__all__ = ["requests_by_client", "score_files", "score_stream", "size_histogram"]
