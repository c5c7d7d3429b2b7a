"""Notices by which the licence scan knows the families."""

from __future__ import annotations

#: Usual short notices of each family, as published.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Released under the Apache 2.0 license.",
        "This project is licensed under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.",
        "Released under the GNU General Public License.",
        "Licensed under the GPL version 3 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License.",
        "Released under the LGPL version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "Proprietary": (
        "All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "Proprietary and confidential. All rights reserved.",
    ),
}
