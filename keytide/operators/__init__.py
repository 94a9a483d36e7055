"""Operations on a table on disk."""
