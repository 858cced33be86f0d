"""Result tables: partition upsert, delete, append."""
