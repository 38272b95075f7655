"""The warehouse layers and the questions asked of them."""
