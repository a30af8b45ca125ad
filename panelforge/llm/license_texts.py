"""Notices of public licence families, and sentences that only mention licences.

Fixed values: wording that documents use to state a licence, as published by the
licence stewards, shortened to the passages that identify a family.
"""

TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License - see the LICENSE file for details.",
        "Licensed under the MIT license. SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GNU GPL version 2 or later. SPDX-License-Identifier: GPL-2.0-or-later",
    ),
    "LGPL": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Distributed under the terms of the modified BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "MPL": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "Licensed under the Eclipse Public License, version 1.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Content is available under CC BY 3.0 unless otherwise noted.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
    ),
    "Public domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work. CC0 1.0 Universal.",
        "This work is dedicated to the public domain under CC0 1.0.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "Proprietary": (
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form "
        "or by any means without the prior written permission of the publisher.",
        "Copyright 2020 Example Corporation. All rights reserved.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ),
}

# Names under which short notices state a family, and the notices' usual forms.
NAMES: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT License", "Expat License"),
    "Apache": ("Apache License, Version 2.0", "Apache License 2.0", "Apache Software License"),
    "GPL": ("GNU General Public License, version 3", "GNU GPL version 2", "GPLv3"),
    "LGPL": ("GNU Lesser General Public License, version 2.1", "GNU LGPL version 3", "LGPLv3"),
    "AGPL": ("GNU Affero General Public License, version 3", "GNU AGPL version 3", "AGPLv3"),
    "BSD": ("BSD License", "BSD 3-Clause License", "2-clause BSD license"),
    "MPL": ("Mozilla Public License, Version 2.0", "MPL 2.0"),
    "ISC": ("ISC License",),
    "EPL": ("Eclipse Public License, version 2.0", "EPL 1.0"),
    "CC-BY": ("CC BY 4.0", "Creative Commons Attribution License"),
    "CC-BY-SA": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike License"),
    "CC-BY-NC": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial License"),
    "Public domain": ("Unlicense", "CC0 1.0 Universal public domain dedication"),
}
FORMS: tuple[str, ...] = (
    "Licensed under the {}.", "Released under the {}.", "Available under the terms of the {}.",
    "Distributed under the {}.", "This work is licensed under {}.", "Code and data are made available under {}.",
)
TEMPLATES = {
    family: (*texts, *(form.format(name) for name in NAMES.get(family, ()) for form in FORMS))
    for family, texts in TEMPLATES.items()
}

# Text about licences that grants none; part of the unknown class.
MENTIONS: tuple[str, ...] = (
    "He lost his driving license after the accident and has to wait a year.",
    "The restaurant applied for a liquor license from the city council.",
    "The company was granted a license to operate a radio station.",
    "Please read the terms and conditions before you use this service.",
    "You may contact the author with questions about this work at any time.",
    "The software was released in the spring under a new name.",
    "The study was published by a public foundation in version 2 of its report.",
    "Fishing without a license is not permitted in the national park.",
    "Poetic license lets the author rearrange the order of events.",
    "The source of the river lies in the mountains, subject to the following conditions of weather.",
    "Our rights as citizens are reserved for no one but ourselves.",
    "Permission to enter the building was granted by the guard at the door.",
    "Copy the file to your home directory and modify it as you like.",
    "The general public is invited to the opening of the library.",
    "This program is broadcast every Sunday, free of charge.",
    "Creative people like common spaces with an international atmosphere.",
)
