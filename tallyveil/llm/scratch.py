"""Tables written once into the folder that the whole cluster shares."""

from ..scratch import batches_of, new_folder, shared_root, staged

__all__ = ["batches_of", "new_folder", "shared_root", "staged"]
