"""Writers: table modes, schema enforcement, exports, file layout."""
