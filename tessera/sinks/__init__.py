"""What leaves the engine: views as JSON, exports, reports, artifacts, the inverted index."""
