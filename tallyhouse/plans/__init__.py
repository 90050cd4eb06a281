"""The retail model: cleaned tables, marts, datasets and questions."""
