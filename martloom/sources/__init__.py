"""Reading the two feeds and storing the warehouse tables."""
